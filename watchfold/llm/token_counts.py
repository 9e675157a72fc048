"""Token counts: unigram forward scores shared along a trie of pre-tokens.

A pre-token is a word ``[^\\x20\\x09-\\x0D]+`` with the word mark before it. Its
tokens are the segmentation of the greatest total score over a fixed vocabulary
of scored pieces (on equal scores the one with fewer tokens). The forward score
of a prefix does not depend on what follows, so the distinct pre-tokens of a
group of documents form a trie whose nodes are scored once each: they are visited
in sorted order, which is the trie's depth-first order, and the scores along the
shared prefix stay on the stack. The count at each terminal is kept for the next
groups in a dictionary of bounded size (a cache: it changes nothing).

Characters that no piece covers fall back to one token per UTF-8 byte.

It is a map over whole texts without a shuffle. Defined cases: a null text counts
as empty (0 and 0); repeated rows are counted each; a table without rows gives no
rows; other columns are ignored. The vocabulary file's path is a parameter.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from watchfold.llm.common import doc_groups, read_table, text_buffer

WORD_MARK = "▁"
CACHE_ENTRIES = 500_000
CACHED_CHARS = 64
FALLBACK = -25.0                 # score of a byte that no piece covers, far below any piece
RESULT = "doc_id long, n_pre_tokens long, n_tokens long"


def load_pieces(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece file with unigram scores. The file ranks its pieces by
    frequency; a piece of rank r gets the log probability of Zipf's law, -log(r + 2)
    less the logarithm of the normalising sum."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [i for i in range(model.vocab_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ranked = sorted(usable, key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / (r + 2) for r in range(len(ranked))))
    return {model.id_to_piece(i): -math.log(r + 2) - total for r, i in enumerate(ranked)}


class PrefixScorer:
    """Best score and fewest tokens of every prefix, shared between sorted pre-tokens."""

    def __init__(self, pieces: dict[str, float]):
        self.backward: dict = {}               # trie over reversed pieces; key "": the score
        for piece, score in pieces.items():
            node = self.backward
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = score

    def counts(self, pre_tokens: list[str]) -> list[int]:
        """Tokens of each of the sorted pre-tokens."""
        out, last = [], ""
        score, tokens = [0.0], [0]             # along the path from the trie's root
        root = self.backward
        for word in pre_tokens:
            shared, limit = 0, min(len(word), len(last))
            while shared < limit and word[shared] == last[shared]:
                shared += 1
            del score[shared + 1:], tokens[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                size = len(word[end - 1].encode("utf-8", "surrogatepass"))
                best, fewest = score[end - 1] + FALLBACK * size, tokens[end - 1] + size
                node, at = root, end
                while at:
                    at -= 1
                    node = node.get(word[at])
                    if node is None:
                        break
                    own = node.get("")
                    if own is not None:
                        own += score[at]
                        if own > best or own == best and tokens[at] + 1 < fewest:
                            best, fewest = own, tokens[at] + 1
                score.append(best)
                tokens.append(fewest)
            out.append(tokens[-1])
            last = word
        return out


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_pre_tokens, n_tokens of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(vocabulary_path))

    def run(batches):
        scorer, known = None, {}
        for batch in batches:
            scorer = scorer or PrefixScorer(shared.value)
            data, offsets = text_buffer(batch.column(1))
            pre, total = [], []
            for lo, hi in doc_groups(offsets):
                raw = data[offsets[lo]:offsets[hi]].tobytes()
                base = offsets[lo]
                words = [raw[offsets[k] - base:offsets[k + 1] - base].split() for k in range(lo, hi)]
                new = {w for row in words for w in row if w not in known}
                if len(known) + len(new) > CACHE_ENTRIES:
                    known.clear()
                    new = {w for row in words for w in row}
                fresh = sorted((WORD_MARK + w.decode(), w) for w in new)
                here = dict(zip((w for _, w in fresh), scorer.counts([t for t, _ in fresh])))
                known.update(here)
                for row in words:
                    pre.append(len(row))
                    total.append(sum(map(known.__getitem__, row)))
                for w in here:                      # long ones are not worth their memory
                    if len(w) > CACHED_CHARS:
                        del known[w]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(pre, pa.int64()), pa.array(total, pa.int64())],
                names=["doc_id", "n_pre_tokens", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def vocabulary_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), vocabulary_file())


QUERIES = {"op2_token_counts": op2_token_counts}
