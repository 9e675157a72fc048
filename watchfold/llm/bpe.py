"""BPE encoding and decoding: a bounded-lookahead streaming transducer.

Encoding reads a pre-token byte by byte. For every prefix it keeps one number,
the last token of that prefix's encoding: the only vocabulary item that ends
there and stands rightly after the last token of the shorter prefix (two
neighbours are right when the merge list encodes their joined bytes as just
these two). A later prefix can reach back only as far as the longest token, so
the sufficient lookahead of a merge list is the length of its longest token:
once the token chains of the last ``lookahead`` prefixes share a boundary,
nothing that follows can move it, the tokens before it are emitted and their
state is dropped. Memory stays constant however long the pre-token is. A pre-token no longer than
the lookahead is wholly visible, so its tokens are found left to right by the same
neighbour rule, stepping back where nothing fits: the encoding is the only
sequence of vocabulary items in which all neighbours are right.

Decoding feeds the bytes of each id into an incremental byte-to-text state
machine, which keeps at most an unfinished character between two pieces.

The result equals that of the public ``tokenizers`` library for byte-level BPE
files: added tokens are cut out of the text first, the rest is split by the
byte-level pattern. Frequent pre-tokens are kept in a dictionary of bounded size
(a cache: it changes nothing in the result).

Defined cases: a null text is encoded as the empty text (no ids); repeated rows
are encoded each; a table without rows gives no rows; other columns are neither
read nor returned. The vocabulary file's path is a parameter; the file is read
on the driver and its contents are broadcast (its size does not depend on the data).
"""

from __future__ import annotations

import codecs
import hashlib
import json
import struct
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchfold.llm.common import give_back, read_table

# Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_ENTRIES = 400_000
CACHED_CHARS = 64                # longer pre-tokens are encoded each time
DECODE_IDS = 200_000             # ids fed to the decoder at a time
RESULT = "doc_id long, n_tokens long, ids binary, decoded string"


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabulary files:
    printable Latin-1 characters for themselves, the others from 256 on in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_vocabulary(path: str) -> dict:
    """Bytes of each id, merges as pairs of bytes in rank order, added tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    as_bytes = lambda token: bytes(letters[c] for c in token)
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    return {"ids": {as_bytes(t): i for t, i in spec["model"]["vocab"].items()},
            "merges": [(as_bytes(a), as_bytes(b)) for a, b in pairs],
            "added": {t["content"]: t["id"] for t in spec.get("added_tokens", [])}}


class Transducer:
    """Encodes bytes with a merge list, left to right, in constant memory."""

    def __init__(self, ids: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.ids = ids
        self.text = {i: t for t, i in ids.items()}
        self.rank = {pair: r for r, pair in enumerate(merges)}
        self.lookahead = max(map(len, ids))
        self.forward = self._trie(False)
        self.right: dict[tuple[int, int], bool] = {}

    def _trie(self, reverse: bool) -> dict:
        """Trie over the tokens, from their ends if ``reverse``; key None: the id."""
        trie: dict = {}
        for token, i in self.ids.items():
            node = trie
            for byte in reversed(token) if reverse else token:
                node = node.setdefault(byte, {})
            node[None] = i
        return trie

    @cached_property
    def backward(self) -> dict:
        """Only pre-tokens longer than the lookahead need it."""
        return self._trie(True)

    def merged(self, data: bytes) -> list[bytes]:
        """The merge list's own rule, used on two neighbours at most."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.rank.get(pair, -1) for pair in zip(parts, parts[1:])]
            least = min((r for r in ranks if r >= 0), default=None)
            if least is None:
                break
            out, i = [], 0
            while i < len(parts):
                if i < len(ranks) and ranks[i] == least:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: the start) in an encoding."""
        left, own = self.text.get(before, b""), self.text[token]
        known = self.merged(left + own) == ([left, own] if left else [own])
        if len(self.right) > CACHE_ENTRIES:
            self.right.clear()
        self.right[before, token] = known
        return known

    def encode_visible(self, data: bytes) -> list[int]:
        """Ids of a pre-token that lies wholly within the lookahead."""
        forward, right, fits, n = self.forward, self.right.get, self.fits, len(data)
        out: list[int] = []
        taken: list[tuple[int, int, list]] = []      # where each token of ``out`` was chosen
        dead: set[tuple[int, int]] = set()
        at, before, options = 0, -1, None
        while at < n:
            if options is None:
                options, node, end = [], forward, at
                while end < n:
                    node = node.get(data[end])
                    if node is None:
                        break
                    end += 1
                    token = node.get(None)
                    if token is not None:
                        options.append((token, end))
            while options:                           # the longest first
                token, end = options.pop()
                known = right((before, token))
                if (known or known is None and fits(before, token)) and (end, token) not in dead:
                    break
            else:
                dead.add((at, before))
                out.pop()
                at, before, options = taken.pop()
                continue
            taken.append((at, before, options))
            out.append(token)
            at, before, options = end, token, None
        return out

    def encode(self, data: Iterable[int]) -> Iterator[int]:
        """Ids of the bytes of one pre-token, each given out as soon as it is stable."""
        lookahead, backward, right, fits = self.lookahead, self.backward, self.right.get, self.fits
        window = bytearray()                   # bytes since the last emitted boundary
        last = [-1]                            # last token of each prefix of the window
        end = 0
        for byte in data:
            window.append(byte)
            end += 1
            node, at, options = backward, end, []
            while at:                          # every vocabulary item that ends here
                at -= 1
                node = node.get(window[at])
                if node is None:
                    break
                token = node.get(None)
                if token is not None:
                    options.append((last[at], token))
            while True:                        # the longest one first; exactly one is right
                pair = options.pop()
                known = right(pair)
                if known or known is None and fits(*pair):
                    break
            last.append(pair[1])
            if end >= 4 * lookahead:
                cut = self._stable(last, end, lookahead)
                if cut:
                    yield from self._chain(last, cut)
                    del window[:cut]
                    last = last[cut:]
                    end -= cut
        yield from self._chain(last, end)

    def _stable(self, last: list[int], end: int, lookahead: int) -> int:
        """The last boundary on which the chains of the last ``lookahead`` prefixes agree."""
        shared: set[int] | None = None
        for at in range(end - lookahead + 1, end + 1):
            chain = set()
            while at > 0:
                chain.add(at)
                at -= len(self.text[last[at]])
            shared = chain if shared is None else shared & chain
        return max(shared, default=0)

    def _chain(self, last: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(last[end])
            end -= len(self.text[last[end]])
        return out[::-1]


class Codec:
    """Text to packed ids (little-endian unsigned 32-bit) and back."""

    def __init__(self, vocabulary: dict, pattern: str = PATTERN):
        import regex

        self.machine = Transducer(vocabulary["ids"], vocabulary["merges"])
        self.split = regex.compile(pattern).findall
        self.added = {t: struct.pack("<I", i) for t, i in vocabulary["added"].items()}
        names = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        size = 1 + max([*vocabulary["ids"].values(), *vocabulary["added"].values()])
        self.bytes_of = [b""] * size
        for token, i in vocabulary["ids"].items():
            self.bytes_of[i] = token
        for token, i in vocabulary["added"].items():
            self.bytes_of[i] = token.encode()
        self.cache: dict[str, bytes] = {}

    def _pre_token(self, piece: str) -> bytes:
        data = piece.encode()
        short = len(data) <= self.machine.lookahead
        ids = self.machine.encode_visible(data) if short else list(self.machine.encode(data))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_CHARS:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[piece] = packed
        return packed

    def _plain(self, text: str) -> bytes:
        pieces, known = self.split(text), self.cache.get
        return b"".join([known(p) or self._pre_token(p) for p in pieces])

    def encode(self, text: str) -> bytes:
        if self.special is None or not any(name in text for name in self.added):
            return self._plain(text)
        return b"".join(self.added.get(part) or self._plain(part) for part in self.special.split(text))

    def decode(self, packed: bytes) -> str:
        state = codecs.getincrementaldecoder("utf-8")("replace")
        ids, token = np.frombuffer(packed, "<u4"), self.bytes_of.__getitem__
        out = [state.decode(b"".join(map(token, ids[at:at + DECODE_IDS].tolist())))
               for at in range(0, len(ids), DECODE_IDS)]
        return "".join(out) + state.decode(b"", True)


def round_trip(docs: DataFrame, vocabulary_path: str, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (packed), decoded of every whole text.

    With ``digests`` the two last columns are the SHA-256 of the packed ids and of
    the decoded UTF-8 instead, so that they never leave the Python worker.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary_path))
    kinds = (pa.string(), pa.string()) if digests else (pa.binary(), pa.string())
    schema = RESULT.replace("ids binary", "ids string") if digests else RESULT

    def run(batches):
        give_back()
        codec = None
        for batch in batches:
            codec = codec or Codec(shared.value)
            keys = batch.column(0)
            for lo in range(0, batch.num_rows, 256):
                sizes, ids, decoded = [], [], []
                for value in batch.column(1)[lo:lo + 256]:
                    packed = codec.encode(value.as_py() or "")
                    text = codec.decode(packed)
                    sizes.append(len(packed) // 4)
                    ids.append(hashlib.sha256(packed).hexdigest() if digests else packed)
                    decoded.append(hashlib.sha256(text.encode()).hexdigest() if digests else text)
                yield pa.RecordBatch.from_arrays(
                    [keys[lo:lo + 256].cast(pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(ids, kinds[0]), pa.array(decoded, kinds[1])],
                    names=["doc_id", "n_tokens", "ids", "decoded"])
            give_back()
        codec = None
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def vocabulary_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = round_trip(read_table(spark, sf_dir, "documents"), vocabulary_file(), digests=True)
    return out.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"),
                      F.col("decoded").alias("decoded_sha256"))


QUERIES = {"op7_bpe": op7_bpe}
