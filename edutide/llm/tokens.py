"""Token counts of whole texts (operator 5).

Texts of up to HUGE characters are counted from their units (units.py). Longer ones are encoded in overlapping chunks with
offsets and spliced: two neighbouring chunks are joined at a boundary that both have, where a non-space character is followed
by a space. The tokenizer's splitting pattern never matches across such a place and never looks back over it, so tokens on
either side of it are those of the whole text: it is stable. As a check, both chunks must also agree on the tokens from there
to the next such place. Where an overlap has no two such places, it is widened, at last to the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import flat, freed, pieces
from .units import UNUSUAL, units

#: Characters of a chunk, and of the overlap of neighbouring chunks at first.
CHUNK, OVERLAP = 32768, 256
HUGE = CHUNK


def _encoded(tokenizer, text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int]]]:
    e = tokenizer.encode(text[start:end], add_special_tokens=False)
    return e.ids, [(a + start, b + start) for a, b in e.offsets]


def _stable(text: str, spans: list[tuple[int, int]], lo: int, hi: int) -> dict[int, int]:
    """Places between lo and hi where a token begins with a space right after a non-space: place -> number of the token."""
    return {a: i for i, (a, _) in enumerate(spans) if lo < a < hi and text[a] == " " and not text[a - 1].isspace() and i and spans[i - 1][1] == a}


def encode_overlapping(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """The ids of text; no encoding is of more than `chunk` characters and what widening adds."""
    done: list[int] = []
    start, end = 0, min(len(text), chunk)
    ids, spans = _encoded(tokenizer, text, start, end)
    while end < len(text):
        wide = overlap
        while True:
            if wide >= end - start:  # nothing to splice at: take this chunk longer
                end = min(len(text), end + (end - start))
                ids, spans = _encoded(tokenizer, text, start, end)
                break
            s, e = end - wide, min(len(text), end + chunk - wide)
            more, more_spans = _encoded(tokenizer, text, s, e)
            left, right = _stable(text, spans, s, end), _stable(text, more_spans, s, end)
            both = sorted(left.keys() & right.keys())
            at = next((a for a, b in zip(both, both[1:]) if ids[left[a] : left[b]] == more[right[a] : right[b]]), None)
            if at is not None:
                done += ids[: left[at]]
                ids, spans = more[right[at] :], more_spans[right[at] :]
                start, end = at, e
                break
            wide *= 2
    return done + ids


def _count(path: str, limit: int):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = units(path)
        for b in pieces(batches, 1 << 19):
            text = b.column("text")
            size = np.diff(flat(text)[1])
            huge = pc.fill_null(pc.and_(pc.greater(pc.utf8_length(text), HUGE), pa.scalar(encoder.kind == "space")), False)
            odd = pc.and_(pc.fill_null(pc.match_substring_regex(text, UNUSUAL), False), pc.invert(huge))
            plain = np.flatnonzero(pc.invert(pc.or_(huge, odd)).to_numpy(zero_copy_only=False))
            n = np.zeros(len(text), np.int64)
            n[plain] = np.diff(encoder.encode(text.take(pa.array(plain)))[1])
            for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
                n[i] = len(encoder.tokenizer.encode(text[i].as_py(), add_special_tokens=False).ids)
            for i in np.flatnonzero(huge.to_numpy(zero_copy_only=False)):
                n[i] = len(encode_overlapping(encoder.tokenizer, text[i].as_py()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens as the file at `path` (a byte-level one of `tokenizers`) gives them, over_limit.

    A tokenizer of another kind encodes each whole text at once. Special strings inside a text count as the library has it by default. Null texts are empty; null and repeated ids come
    back row by row; an empty table gives no rows; other columns are not read. There is no shuffle.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_count(path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
