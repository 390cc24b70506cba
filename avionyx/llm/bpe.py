"""Byte-pair encoding and decoding with content-defined chunk reuse (operator 3).

1. A rolling hash over the characters cuts every text into chunks whose
   borders depend on nearby characters only, so texts that share a passage
   share its chunks wherever the passage starts.
2. Documents are routed by the smallest of their chunk hashes: texts with much
   in common meet in one partition (a routed key with very many rows is split
   by Spark at run time, the ``REBALANCE`` hint).
3. Inside a task every distinct chunk is encoded and decoded once and kept in a
   cache of bounded size, which goes when the task ends: the worker does other work next.
4. A border may cut a word.  The encoded form of a chunk therefore keeps the
   characters before its first and after its last blank as text; a join
   re-encodes the two loose ends together, growing over further chunks until
   the piece is closed by blanks on both sides.  The pre-tokenizer never looks
   across a blank, so from there on the ids agree with those of the whole text.

Results are those of the ``tokenizers`` library on the whole text.  A null text
counts as empty: no ids, empty decoded text.  Repeated rows and rows with a
null id are encoded like any other.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from avionyx.llm.text import append_column, free_name, giving_back, slices

WINDOW = 16
MASK = np.uint32(0xFF)  # one border in 256 characters
LEAST_CHUNK, LONGEST_CHUNK = 32, 4096
BLANKS = " \t\n\r"
CACHE_CHARS = 6_000_000
CACHE_WORDS = 250_000

_POWERS = [np.uint32(pow(0x01000193, WINDOW - 1 - i, 2**32)) for i in range(WINDOW)]


def rolling_hashes(text: str) -> np.ndarray:
    """Polynomial hash of the ``WINDOW`` characters that end at each position (from the first full window on)."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(x) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    h = x[:n] * _POWERS[0]
    for i in range(1, WINDOW):
        h += x[i : i + n] * _POWERS[i]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(13))


def chunks(text: str) -> list[str]:
    """``text`` cut at content-defined borders."""
    h = rolling_hashes(text)
    out, start = [], 0
    for cut in (np.flatnonzero((h & MASK) == 0) + WINDOW).tolist():
        while cut - start > LONGEST_CHUNK:
            out.append(text[start : start + LONGEST_CHUNK])
            start += LONGEST_CHUNK
        if cut - start >= LEAST_CHUNK:
            out.append(text[start:cut])
            start = cut
    while len(text) - start > LONGEST_CHUNK:
        out.append(text[start : start + LONGEST_CHUNK])
        start += LONGEST_CHUNK
    if start < len(text):
        out.append(text[start:])
    return out


def _route(texts: list[str | None]) -> list[int]:
    """The smallest chunk hash of each text."""
    out = []
    for text in texts:
        cut = chunks(text) if text else [""]
        out.append(min(int.from_bytes(hashlib.blake2b(c.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) for c in cut))
    return out


class _Cache(dict):
    """Two generations: when the younger is full, the older is dropped."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.held, self.old = limit, 0, {}

    def find(self, key):
        value = self.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.add(key, value, 0)
        return value

    def add(self, key, value, cost: int = 1):
        if self.held >= self.limit:
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += cost or 1
        self[key] = value

    def forget(self) -> None:
        self.clear()
        self.held, self.old = 0, {}


class ChunkCodec:
    """Encoder and decoder over chunks, for one tokenizer file.

    The ids of a text are those of its pieces, the runs without ``BLANKS``, in
    order.  Text of plain letters, digits and signs is cut into the
    pre-tokenizer's parts here and each distinct part goes to the model once; a
    piece with anything that the normalizer or the added tokens could touch goes
    through the whole library.
    """

    # blanks, ASCII, and the Latin letters whose lower case and composed form are one character
    PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
    # the pre-tokenizer's own pattern (fixed value), over lower-cased plain characters
    PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token = {i: t for t, i in vocabulary.items()}
        self.joins_by_space = self.tokenizer.decoder is None
        self.parts = _Cache(CACHE_WORDS)
        self.pieces = _Cache(CACHE_WORDS // 4)
        self.chunks = _Cache(CACHE_CHARS)
        self.splits_at_blanks = self._blanks_split()
        self.fast = self.splits_at_blanks and self._same_as_library()

    def _blanks_split(self) -> bool:
        """Whether blanks carry no ids and always separate, as chunk reuse needs."""
        return not any(self._library(b) for b in BLANKS) and all(
            self._library(f"{x}{b}{y}") == self._library(x) + self._library(y)
            for b in [*BLANKS, " \n "]
            for x, y in (("ab", "cd"), ("1", "2"), ("#", "#"), ("don", "'t"), ("é", "\u0301"))
        )

    def _same_as_library(self) -> bool:
        """Whether the direct path gives the library's ids on a probe of every plain character."""
        plain = [chr(c) for c in range(33, 256) if self.PLAIN.fullmatch(chr(c))]
        probes = [a + "Ab" for a in plain] + ["x" + a + "'LL" for a in plain] + ["don't12'sé"]
        try:
            return all(self._plain(p)[0] == self._packed(self._library(p)) for p in probes)
        except Exception:  # a model that is not byte level refuses the mapped form
            return False

    _BYTES = {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    _BYTES |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()

    def _part(self, part: str) -> tuple[bytes, str]:
        """One lower-cased plain part, by the model itself."""
        mapped = part if part.isascii() else part.encode().decode("latin-1").translate(self._BYTES)
        tokens = self.model.tokenize(mapped)
        return self._packed([t.id for t in tokens]), " ".join([t.value for t in tokens])

    def _plain(self, text: str) -> tuple[bytes, str | None]:
        """Ids and decoded text of plain characters."""
        parts = self.PARTS.findall(text.lower())
        if not parts:
            return b"", None
        cache = self.parts
        found = list(map(cache.get, parts))
        if None in found:
            at = found.index(None)
            while at >= 0:
                value = cache.find(parts[at])
                if value is None:
                    value = self._part(parts[at])
                    cache.add(parts[at], value)
                found[at] = value
                try:
                    at = found.index(None, at + 1)
                except ValueError:
                    break
        return b"".join([v[0] for v in found]), " ".join([v[1] for v in found])

    def forget(self) -> None:
        """Empty the caches; the tokenizer stays."""
        for cache in (self.parts, self.pieces, self.chunks):
            cache.forget()

    def _library(self, piece: str) -> list[int]:
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        if self.joins_by_space:  # the library joins the tokens by blanks where a file names no decoder
            return " ".join([self.token[i] for i in ids])
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def piece(self, piece: str) -> tuple[bytes, str | None]:
        """Ids as little-endian 32-bit integers, and the decoded text (None: no ids)."""
        if self.fast and "<|" not in piece and self.PLAIN.fullmatch(piece):
            return self._plain(piece)
        found = self.pieces.find(piece)
        if found is None:
            ids = self._library(piece)
            found = (self._packed(ids), self.decode(ids) if ids else None)
            self.pieces.add(piece, found)
        return found

    def run(self, text: str) -> tuple[bytes, str | None]:
        """Ids and decoded text of characters that blanks close on both sides."""
        if self.fast and "<|" not in text and self.PLAIN.fullmatch(text):
            return self._plain(text)
        found = [self.piece(p) for p in _spaced(text).split(" ") if p]
        parts = [d for _, d in found if d is not None]
        return b"".join([i for i, _ in found]), " ".join(parts) if parts else None

    def chunk(self, chunk: str) -> tuple[str, tuple | None, str]:
        """Characters before the first blank, what lies between the outer blanks, characters after the last."""
        found = self.chunks.find(chunk)
        if found is None:
            spaced = _spaced(chunk)
            first, last = spaced.find(" "), spaced.rfind(" ")
            found = (chunk, None, "") if first < 0 else (chunk[:first], self.run(chunk[first:last]), chunk[last + 1 :])
            self.chunks.add(chunk, found, len(chunk))
        return found

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids (little-endian 32-bit integers) and decoded text of a whole text.

        A tokenizer that gives blanks ids of their own offers no border at
        which pieces agree; its texts go to the library whole.
        """
        if not self.splits_at_blanks:
            whole = self._library(text)
            return np.array(whole, "<u4").tobytes(), self.decode(whole)
        ids: list[bytes] = []
        decoded: list[str] = []
        loose = ""

        def put(part: tuple[bytes, str | None]) -> None:
            ids.append(part[0])
            if part[1] is not None:
                decoded.append(part[1])

        for c in chunks(text):
            head, inside, tail = self.chunk(c)
            if inside is None:
                loose += head
                continue
            if loose or head:
                put(self.piece(loose + head))
            put(inside)
            loose = tail
        if loose:
            put(self.piece(loose))
        if self.joins_by_space:
            return b"".join(ids), " ".join(decoded)
        whole = b"".join(ids)
        return whole, self.decode(np.frombuffer(whole, "<u4").tolist())


def _spaced(text: str) -> str:
    """``text`` with every blank as a space."""
    for b in BLANKS[1:]:
        text = text.replace(b, " ")
    return text


_CODECS: dict[str, ChunkCodec] = {}


def codec(path: str) -> ChunkCodec:
    """The codec of a tokenizer file, one per Python worker."""
    if path not in _CODECS:
        _CODECS[path] = ChunkCodec(path)
    return _CODECS[path]


def routed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` dealt out by the smallest chunk hash of each text."""
    key = free_name(docs, "route")
    keyed = append_column(docs, text_col, key, T.LongType(), _route)
    return keyed.hint("rebalance", F.col(key)).drop(key)


def encode_documents(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns ``ids`` (array of int) and ``decoded`` appended."""
    kind = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def make(texts: list[str | None]) -> list[dict]:
        c = codec(tokenizer_path)
        out = []
        for text in texts:
            ids, decoded = c.encode(text or "")
            out.append({"ids": np.frombuffer(ids, "<u4").astype(np.int32), "decoded": decoded})
        return out

    name = free_name(docs, "encoded")
    made = append_column(routed(docs, text_col), text_col, name, kind, make, lambda: codec(tokenizer_path).forget())
    return made.select(*[F.col(f"`{c}`") for c in docs.columns], f"{name}.ids", f"{name}.decoded")


_DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, the number of ids, and the SHA-256 of ids and of decoded text.

    The digests are taken where the ids are made, so neither ids nor decoded
    texts leave the task.
    """
    rows = routed(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")))

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                sizes, ids_sha, text_sha = [], [], []
                for text in texts[lo:hi]:
                    ids, decoded = c.encode(text or "")
                    sizes.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(sizes, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        c.forget()

    return rows.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {_DIGEST}")
