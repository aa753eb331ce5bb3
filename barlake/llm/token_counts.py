"""Token counts of sections: whole documents are encoded once, tokens are attributed by offset."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .bpe import _texts, encode_texts, offsets, vocabulary_path
from .common import per_batch, table

#: To which section a token that crosses a boundary counts.
RULES = ("start", "end", "majority")


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sections of a text: its lines, each with the line end that closes it."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    stops = np.flatnonzero(points == 10) + 1
    if not len(stops) or stops[-1] != len(points):
        stops = np.append(stops, len(points))
    return np.concatenate(([0], stops[:-1])), stops


def attribute(starts: np.ndarray, ends: np.ndarray, section_stops: np.ndarray, rule: str) -> np.ndarray:
    """Index of the section each token (first character, one after the last) counts to.

    Sections are contiguous and given by their ends, so the join of intervals is a search in
    sorted ends. ``start``: the section of the first character; ``end``: of the last one;
    ``majority``: the section with most of its characters, the earlier one if two have as many.
    """
    first = np.searchsorted(section_stops, starts, side="right")
    if rule == "start":
        return first
    last = np.searchsorted(section_stops, ends - 1, side="right")
    if rule == "end":
        return last
    out = first.copy()
    for i in np.flatnonzero(first != last):
        cuts = [starts[i], *section_stops[first[i] : last[i]], ends[i]]
        out[i] = first[i] + int(np.argmax(np.diff(cuts)))
    return out


def section_tokens(docs: DataFrame, rule: str = "majority", path: str | None = None) -> DataFrame:
    """doc_id, section (from 0), section_start, section_end (code points), n_tokens of every line.

    A document is encoded whole, once; its sections' counts add up to its token count. A
    null or empty text is one empty section without tokens. Repeated rows give repeated
    results; other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batch: pa.RecordBatch):
        vocabulary = path or vocabulary_path()
        for start, _, texts in _texts(batch, "text"):
            rows, section, opens, closes, counts = [], [], [], [], []
            for i, (text, ids) in enumerate(zip(texts, encode_texts(texts, vocabulary)), start):
                begin, stop = lines(text)
                own = attribute(*offsets(text, ids, vocabulary), stop, rule)
                rows.append(np.full(len(stop), i))
                section.append(np.arange(len(stop)))
                opens.append(begin)
                closes.append(stop)
                counts.append(np.bincount(own, minlength=len(stop)))
            if rows:
                ids_of = batch.column("doc_id").take(pa.array(np.concatenate(rows)))
                made = [pa.array(np.concatenate(x).astype(np.int64)) for x in (section, opens, closes, counts)]
                names = ["doc_id", "section", "section_start", "section_end", "n_tokens"]
                yield pa.RecordBatch.from_arrays([ids_of, *made], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        per_batch(run), f"doc_id {kind}, section long, section_start long, section_end long, n_tokens long"
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; a crossing token counts where most of it lies."""
    return section_tokens(table(spark, sf_dir, "documents"))
