"""Token counts of a byte-level BPE tokenizer without merging most of the text.

On the driver, once per tokenizer file: which vocabulary strings are one pre-token and encode alone as one token (they
count as one wherever the splitter yields them), and for which characters the local splitter cuts otherwise than the
library. Tasks split each text, count proven pre-tokens directly and merge only the rest; texts with special strings or
doubtful characters go through the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, fields_and, per_batch

MAX_PIECES, MAX_PIECE_CHARS, CHUNK = 400_000, 64, 1 << 20
#: Fixed value: the splitter of the byte-level tokenizers (public_tokenizers.PATTERN).
SPLITTER = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHECKED_PLANES = 2
#: Strings or characters the driver puts to the library at once; what comes back takes far more room than they do.
PROVEN_AT_ONCE = 4096


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def _parts_of(items: list) -> Iterator[list]:
    for i in range(0, len(items), PROVEN_AT_ONCE):
        yield items[i : i + PROVEN_AT_ONCE]


@lru_cache(maxsize=4)
def prove(path: str) -> tuple[str, frozenset[str], frozenset[str], tuple[str, ...]]:
    """Tokenizer text, strings proven to be one token, doubtful characters of the checked planes, special strings."""
    import regex
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    pre = spec["pre_tokenizer"]
    if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True):
        raise ValueError(f"{path}: only byte-level tokenizers with the standard splitter are supported")
    tokenizer, splitter = Tokenizer.from_str(text), regex.compile(SPLITTER)
    special = tuple(t["content"] for t in spec["added_tokens"])
    value = {letter: b for b, letter in enumerate(byte_letters())}

    strings = []
    for token in spec["model"]["vocab"]:
        try:
            strings.append(bytes(value[c] for c in token).decode())
        except (UnicodeDecodeError, KeyError):
            continue
    strings = [s for s in strings if splitter.findall(s) == [s] and s not in special]
    whole = frozenset(
        s for some in _parts_of(strings)
        for s, e in zip(some, tokenizer.encode_batch(some, add_special_tokens=False), strict=True) if len(e.ids) == 1
    )

    # Every character between a letter and a digit: the cuts on both sides show its class.
    # A digit before a letter is cut everywhere, so the characters may be checked part by part.
    odd: set[str] = set()
    for points in _parts_of([c for c in range(0x80, CHECKED_PLANES << 16) if not 0xD800 <= c <= 0xDFFF]):
        probe = "".join(f"a{chr(c)}1" for c in points)
        here = {m.span() for m in splitter.finditer(probe)}
        there = {span for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(probe)}
        odd.update(probe[i] for a, b in here ^ there for i in range(a, b))
    return text, whole, frozenset(odd - {"a", "1"}), special


class _Pieces(dict):
    """Tokens of a pre-token; unknown ones are merged by the library and kept up to a bound."""

    def __init__(self, whole, merge):
        super().__init__((s, 1) for s in whole)
        self.merge = merge
        self.most = len(self) + MAX_PIECES

    def __missing__(self, piece: str) -> int:
        n = self.merge(piece)
        if len(piece) <= MAX_PIECE_CHARS and len(self) < self.most:
            self[piece] = n
        return n


def make_counter(proof: tuple) -> Callable[[bytes], int]:
    """Function from a UTF-8 text to its number of tokens; ``proof`` comes from ``prove``."""
    import regex
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    text, whole, odd, special = proof
    tokenizer, splitter = Tokenizer.from_str(text), regex.compile(SPLITTER)
    letters = byte_letters()
    tokenize = tokenizer.model.tokenize
    pieces = _Pieces(whole, lambda piece: len(tokenize("".join([letters[b] for b in piece.encode()]))))
    edge = re.compile(r"(?<=\S) (?=\S)")
    beyond = chr(CHECKED_PLANES << 16)
    # First UTF-8 bytes of doubtful characters or larger ones; most texts have none of them.
    leads = bytes(range(min(odd, default=beyond).encode()[0], 256))

    def doubtful(text: str, data: bytes) -> bool:
        if len(data.translate(None, leads)) == len(data):
            return False
        found = set(text)
        return not odd.isdisjoint(found) or max(found) >= beyond

    def parts(text: str):
        """Cuts of a very long text in front of a lone space, where the splitter cuts too."""
        start = 0
        while len(text) - start > CHUNK and (cut := edge.search(text, start + CHUNK)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def count(data: bytes) -> int:
        text = data.decode()
        if any(s in text for s in special) or doubtful(text, data):
            return len(tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(sum(map(pieces.__getitem__, splitter.findall(part))) for part in parts(text))

    return count


def with_token_counts(rows: DataFrame, text_col: str, tokenizer_path: str, name: str = "n_tokens") -> DataFrame:
    """The rows without their text, with its number of tokens; a null text has none."""
    proof = prove(tokenizer_path)
    kept = [f for f in rows.schema.fields if f.name not in (text_col, name)]

    def build():
        count = make_counter(proof)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = pa.array([count(x) for x in as_bytes(batch.column(text_col))], pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [counts], [f.name for f in kept] + [name]
            )

        return run

    return per_batch(rows, build, fields_and(kept, f"`{name}` long"))


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    A null or empty text has 0 bytes and 0 tokens; rows without an id and repeated rows are counted like any other.
    """
    text: Column = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    return with_token_counts(rows, "text", tokenizer_path).withColumn("over_limit", F.col("n_tokens") > limit)
