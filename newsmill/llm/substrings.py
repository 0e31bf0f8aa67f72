"""Substring deduplication by line, sentence or paragraph hashing.

Texts are cut into units.  Units are normalised and digested, the digests are grouped over the whole corpus, and the earliest ranked
occurrence of each stays.  A later one is cut out where it stands in a run of consecutive repeated units that has enough words
together, so that short lines which many texts happen to share stay.  The offsets of what was cut, in the original text, are kept."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from newsmill.session import materialize

# a sentence ends at a line break, or at white space behind a sentence mark
_SEPARATOR = {"line": re.compile("\n"), "paragraph": re.compile(r"\n[ \t\r]*\n\s*"), "sentence": re.compile(r"\n|(?<=[.!?])[^\S\n]+")}
MIN_WORDS = 25  # of a run: half of the shortest passage (50 words) that must not stay twice


def normalise(unit: str) -> str:
    """Lower case with single spaces; the identity under which units are compared."""
    return " ".join(unit.lower().split())


def unit_spans(text: str, unit: str) -> list[tuple[int, int]]:
    """Start and end of every unit in code points, without the separator behind it."""
    out, at = [], 0
    for m in _SEPARATOR[unit].finditer(text):
        out.append((at, m.start()))
        at = m.end()
    return [*out, (at, len(text))]


def numbered(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` written once with ``_row``, a number of every row, and ``_tie``, a hash of its text."""
    return materialize(docs.withColumns({"_row": F.monotonically_increasing_id(), "_tie": F.xxhash64(text)}))


def word_units(text: str, unit: str) -> list[tuple[int, int, int]]:
    """Start, end and the end of the separator behind of every unit that has a word."""
    spans = unit_spans(text, unit)
    ends = [s for s, _ in spans[1:]] + [len(text)]
    return [(s, e, upto) for (s, e), upto in zip(spans, ends) if not (s == e or text[s:e].isspace())]


def corpus_units(rows: DataFrame, unit: str = "sentence", key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, key, tie, no, start, digest): the units that have a word, numbered within their text, with a 128-bit digest of the normal form.
    ``rows`` comes from :func:`numbered`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, no, start, digest = [], [], [], []
            for i, whole in enumerate(b.column(3).to_pylist()):
                if not whole:
                    continue
                units = word_units(whole, unit)
                low = whole.lower()
                same = len(low) == len(whole)  # few characters change their length
                at += [i] * len(units)
                no += range(len(units))
                start += [s for s, _, _ in units]
                for s, e, _ in units:
                    normal = " ".join(low[s:e].split()) if same else normalise(whole[s:e])
                    digest.append(hashlib.blake2b(normal.encode("utf-8", "surrogatepass"), digest_size=16).digest())
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in range(3)), pa.array(no, pa.int32()), pa.array(start, pa.int32()),
                                              pa.array(digest, pa.binary())], ["row", "key", "tie", "no", "start", "digest"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col("_row").alias("row"), F.col(key).alias("key"), F.col("_tie").alias("tie"), F.col(text).alias("text")).mapInArrow(
        run, f"row long, key {kind}, tie long, no int, start int, digest binary")


def repeated_units(units: DataFrame) -> DataFrame:
    """(row, units): per text the numbers of its later occurrences of units, with key and start of the earliest one.

    Occurrences are ranked by key (null last), text and row, then place.  Minimum and count are partial aggregates; only digests that occur more
    than once are written and joined, as a plain table, so that Spark splits the units of a frequent digest like any skewed join side."""
    rank = F.struct(F.col("key").isNull().alias("no_key"), "key", "tie", "row", "no", "start")
    first = materialize(units.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    later = units.select("row", "no", "digest").join(first, "digest").where((F.col("row") != F.col("first.row")) | (F.col("no") != F.col("first.no")))
    unit = F.struct("no", F.col("first.key").alias("kept_key"), F.col("first.start").alias("kept_start"))
    return later.groupBy("row").agg(F.collect_list(unit).alias("units"))


def cut_runs(text: str, repeated: dict[int, tuple], unit: str, min_words: int) -> tuple[str, list[dict]]:
    """The text without the runs of consecutive repeated units that have ``min_words`` words together, and what was cut.

    ``repeated`` maps numbers of units to key and start of their earliest occurrence.  Behind a removed unit the text goes on at ``cut``: at the next
    unit of its run; for the last one behind its separator, or before it where that is the break of a line whose beginning stays."""
    units = word_units(text, unit)
    pieces, removed, at = [], [], 0
    numbers = sorted(repeated)
    lo = 0
    for hi in range(1, len(numbers) + 1):
        if hi < len(numbers) and numbers[hi] == numbers[hi - 1] + 1:
            continue
        stretch = [units[n] for n in numbers[lo:hi]]
        kept = [repeated[n] for n in numbers[lo:hi]]
        lo = hi
        if sum(len(text[s:e].split()) for s, e, _ in stretch) < min_words:
            continue
        first, (_, end, behind) = stretch[0][0], stretch[-1]
        if text[end:end + 1] == "\n" and first > 0 and text[first - 1] != "\n":
            behind = end
        for (s, e, _), (key, start), cut in zip(stretch, kept, [*(s for s, _, _ in stretch[1:]), behind]):
            removed.append({"start": s, "end": e, "kept_doc_id": key, "kept_start": start, "cut": cut})
        pieces.append(text[at:first])
        at = behind
    out = "".join([*pieces, text[at:]]) if removed else text
    return out[:-1] if removed and at == len(text) and out.endswith("\n") else out, removed


def remove_repeated_units(docs: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document with its later repeats cut out.

    Returns the columns of ``docs`` with the new text, and removed (array of structs start, end, kept_doc_id, kept_start, cut in
    offsets of the original text, ordered; from start to cut the text is gone).  Where the last unit of a text goes, the line break before it goes too.

    ``unit`` is line, sentence (lines cut at sentence marks) or paragraph.  Every unit with a word is compared, however short; it is removed
    if it is no earliest occurrence and stands in a run of such units, no other unit between them, of ``min_words`` words or more.  Occurrences
    are ranked by (``key``, text, offset), null keys last; every row is a text of its own, so repeated rows, rows
    without a key and different texts of one key repeat each other.  Null and empty texts have no units and come back as they are; an empty table
    gives an empty result.  A column ``removed`` is replaced; names ``_row``, ``_tie`` and ``_units`` must be free."""
    rows = numbered(docs.drop("removed"), key, text)
    repeated = repeated_units(corpus_units(rows, unit, key, text))
    kept = [c for c in docs.columns if c != "removed"]
    joined = rows.join(repeated.select(F.col("row").alias("_row"), F.col("units").alias("_units")), "_row", "left").select(*kept, "_units")
    place = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            units = b.column(len(kept))
            texts, removed = b.column(place).to_pylist(), [[] for _ in range(b.num_rows)]
            for i in np.flatnonzero(np.asarray(units.is_valid())):
                texts[i], removed[i] = cut_runs(texts[i], {u["no"]: (u["kept_key"], u["kept_start"]) for u in units[int(i)].as_py()}, unit, min_words)
            own = units.type.value_type.field("kept_key").type
            types = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kept_doc_id", own), ("kept_start", pa.int64()), ("cut", pa.int64())]))
            columns = [*b.columns[:place], pa.array(texts, b.column(place).type), *b.columns[place + 1:len(kept)], pa.array(removed, types)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "removed"])

    kind = rows.schema[key].dataType
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kept_doc_id", kind),
                         T.StructField("kept_start", T.LongType()), T.StructField("cut", T.LongType())])
    return joined.mapInArrow(run, T.StructType([*(rows.schema[c] for c in kept), T.StructField("removed", T.ArrayType(span))]))
