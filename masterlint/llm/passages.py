"""Removal of repeated runs of lines and sentences by their digests, as DataFrame operations on units.

A unit is a line, cut further behind each sentence end; the full-width stops of scripts without spaces end a
sentence wherever they stand. A short unit alone is no passage, so what is compared is a run: a unit with as many
of the following ones as make LEAST_WORDS words, by a digest of their lower-case words. Of equal runs the
earliest by (doc_id, text, place) stays. The others are removed; overlapping ones are one removal, reported with
its place in the original text. A passage may begin and end inside a sentence: the units beside a removal are
compared word by word with those beside the kept occurrence, and the removal grows over the words they share.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlint.llm.common import pieces, written

#: Words of the shortest run that is compared.
LEAST_WORDS = 16
#: So many shared words beside a removal belong to it; fewer are chance.
LEAST_BORDER = 3
_UNIT = re.compile(r"[^\n]*?(?:[.!?]+(?=\s)|[。！？｡]+[」』”’）]*|\n|\Z)")
#: Letters of scripts without spaces; two of them count as a word.
_UNSPACED = re.compile(r"[฀-໿က-႟ក-៿぀-ヿ㐀-鿿]")


def spans(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each unit, blanks around it left out."""
    for match in _UNIT.finditer(text):
        unit = match.group()
        body = unit.strip()
        if body:
            start = match.start() + len(unit) - len(unit.lstrip())
            yield start, start + len(body)


def runs(text: str) -> Iterator[tuple[int, int, int, int, bytes]]:
    """First and last unit, start, stop and digest of each run of text; the rest of a text that has not
    LEAST_WORDS words begins none."""
    places = list(spans(text))
    words, sizes = [], []
    for start, stop in places:
        unit = text[start:stop]
        split = unit.lower().split()
        words.append(" ".join(split).encode("utf-8", "surrogatepass"))
        sizes.append(max(len(split), len(_UNSPACED.findall(unit)) // 2))
    last, size = -1, 0
    for first, (start, _) in enumerate(places):
        while size < LEAST_WORDS:
            last += 1
            if last == len(places):
                return
            size += sizes[last]
        digest = hashlib.blake2b(b"\n".join(words[first : last + 1]), digest_size=16).digest()
        yield first, last, start, places[last][1], digest
        size -= sizes[first]


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, text_id (a hash of the text, which tells rows of one id or none apart) and text."""
    return docs.selectExpr("doc_id", "xxhash64(text) AS text_id", "text")


def found_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, first, last (units), start, stop (characters) and digest of every run."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kinds = {"first": pa.int32(), "last": pa.int32(), "start": pa.int32(), "stop": pa.int32(), "digest": pa.binary()}

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            at, found = [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                if text:
                    some = list(runs(text))
                    found += some
                    at += [row] * len(some)
            columns = list(zip(*found, strict=True)) or [[]] * 5
            places = pa.array(at, pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(places), batch.column(1).take(places), *arrays], names=["doc_id", "text_id", *kinds])

    return _named(docs).mapInArrow(cut, f"doc_id {id_type}, text_id bigint, first int, last int, start int, stop int, digest binary")


def _beside(text: str, places: list[tuple[int, int]], unit: int, from_end: bool) -> tuple[int, int]:
    """Where what may be shared beside a run begins and stops: the unit before it, or behind it as many as make
    LEAST_WORDS words, which would be in the run if they were shared, and one more."""
    if from_end:
        return places[unit]
    size, last = 0, unit
    while last + 1 < len(places) and size < LEAST_WORDS:
        start, stop = places[last]
        size += max(len(text[start:stop].split()), len(_UNSPACED.findall(text, start, stop)) // 2)
        last += 1
    return places[unit][0], places[last][1]


def _borders(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, text_id, unit, from_end, begin and border (the text there) of the wanted (doc_id, text_id, unit,
    from_end) that exist."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    lists = wanted.groupBy("doc_id", "text_id").agg(F.collect_set(F.struct("unit", "from_end")).alias("units")).withColumnRenamed("doc_id", "of_id")
    texts = _named(docs).join(lists, ["text_id"]).where("doc_id <=> of_id").select("doc_id", "text_id", "text", "units")
    kinds = {"unit": pa.int32(), "from_end": pa.bool_(), "begin": pa.int32(), "border": pa.string()}

    def picked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            at, rows = [], []
            for row, (text, units) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                places = list(spans(text))
                for unit, from_end in (u.values() for u in units):
                    if 0 <= unit < len(places):
                        begin, stop = _beside(text, places, unit, from_end)
                        rows.append((unit, from_end, begin, text[begin:stop]))
                        at.append(row)
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            taken = pa.array(at, pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(1).take(taken), *arrays], names=["doc_id", "text_id", *kinds])

    # repeated rows give the same borders
    found = texts.mapInArrow(picked, f"doc_id {id_type}, text_id bigint, unit int, from_end boolean, begin int, border string")
    return found.dropDuplicates(["doc_id", "text_id", "unit", "from_end"])


def shared(text: str, kept: str, from_end: bool) -> int | None:
    """Where the words begin that text shares with kept at its end, or where those end that it shares at its
    start; None if they are fewer than LEAST_BORDER."""
    mine = list(re.finditer(r"\S+", text))
    theirs = kept.lower().split()
    order, other = (mine[::-1], theirs[::-1]) if from_end else (mine, theirs)
    n = 0
    while n < min(len(order), len(other)) and order[n].group().lower() == other[n]:
        n += 1
    if n < LEAST_BORDER:
        return None
    return order[n - 1].start() if from_end else order[n - 1].end()


def _grown(removed: DataFrame, docs: DataFrame) -> DataFrame:
    """removed with the places to which its borders grow: doc_id, text_id, run, start and stop, one of them null."""
    left = removed.selectExpr(
        "doc_id", "text_id", "run", "true AS from_end", "first - 1 AS unit", "kept.doc_id AS kept_id", "kept.text_id AS kept_text", "kept.first - 1 AS kept_unit"
    )
    right = removed.selectExpr(
        "doc_id", "text_id", "run", "false AS from_end", "last + 1 AS unit", "kept_last.doc_id AS kept_id", "kept_last.text_id AS kept_text", "kept_last.last + 1 AS kept_unit"
    )
    borders = left.unionByName(right).where("unit >= 0 AND kept_unit >= 0")
    kept = borders.selectExpr("kept_id AS doc_id", "kept_text AS text_id", "kept_unit AS unit", "from_end")
    texts = written(_borders(docs, borders.select(*kept.columns).unionByName(kept)), "passage-borders")
    mine = texts.toDF("m_id", "m_text", "m_unit", "m_side", "begin", "border")
    theirs = texts.toDF("t_id", "t_text", "t_unit", "t_side", "t_begin", "kept_border")
    pairs = borders.join(mine, F.expr("text_id = m_text AND unit = m_unit AND from_end = m_side AND doc_id <=> m_id")).join(
        theirs, F.expr("kept_text = t_text AND kept_unit = t_unit AND from_end = t_side AND kept_id <=> t_id")
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def grown(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            starts, stops = [], []
            for from_end, begin, text, kept in zip(*(batch.column(i).to_pylist() for i in range(3, 7)), strict=True):
                at = shared(text, kept, from_end)
                starts.append(begin + at if from_end and at is not None else None)
                stops.append(begin + at if not from_end and at is not None else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(starts, pa.int32()), pa.array(stops, pa.int32())], names=["doc_id", "text_id", "run", "start", "stop"])

    rows = pairs.select("doc_id", "text_id", "run", "from_end", "begin", "border", "kept_border")
    return rows.mapInArrow(grown, f"doc_id {id_type}, text_id bigint, run int, start int, stop int")


def removals(docs: DataFrame) -> DataFrame:
    """One row per passage that repeats an earlier one: doc_id, text_id, start, stop, kept_doc_id, kept_start.

    Earliest is the smallest (doc_id, text_id, place), a null id last; text_id tells different texts of one id,
    or of none, apart. Rows of equal id and text are one document's: what they repeat of each other stays, and
    their removals are given once. Null, empty and short texts have no runs; an empty table gives no rows; other
    columns are ignored. The digests of a hot run are combined before the shuffle, and the join back to the runs
    splits a hot digest. What is gathered per document are its own runs and the numbers of its units.
    """
    found = written(found_runs(docs), "runs")
    rank = "struct(doc_id IS NULL AS no_id, doc_id, text_id, first, last, start)"
    firsts = found.groupBy("digest").agg(F.min(F.expr(rank)).alias("kept"), F.count("*").alias("n"))
    repeated = written(firsts.where("n > 1").select("digest", "kept"), "repeated-runs")
    pairs = found.join(repeated, "digest").where("NOT (doc_id <=> kept.doc_id AND text_id = kept.text_id AND start = kept.start)")
    of_text = "PARTITION BY doc_id, text_id ORDER BY first"
    begins = pairs.withColumn("before", F.expr(f"max(last) OVER ({of_text} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"))
    numbered = begins.withColumn("run", F.expr(f"CAST(sum(IF(first > coalesce(before, -2) + 1, 1, 0)) OVER ({of_text} ROWS UNBOUNDED PRECEDING) AS int)"))
    removed = written(
        numbered.groupBy("doc_id", "text_id", "run").agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.min("start").alias("start"),
            F.max("stop").alias("stop"),
            F.min_by("kept", "first").alias("kept"),
            F.max_by("kept", "last").alias("kept_last"),
        ),
        "removed-runs",
    )
    columns = ["doc_id", "text_id", "run", "start", "stop"]
    all_places = removed.select(*columns, "kept.doc_id", "kept.start").toDF(*columns, "kept_doc_id", "kept_start")
    ends = _grown(removed, docs).withColumns({"kept_doc_id": F.lit(None).cast(docs.schema["doc_id"].dataType), "kept_start": F.lit(None).cast("int")})
    whole = all_places.unionByName(ends).groupBy("doc_id", "text_id", "run")
    return whole.agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.max("kept_doc_id").alias("kept_doc_id"), F.max("kept_start").alias("kept_start")
    ).drop("run")


def cleaned(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """docs (doc_id, text) without the removed spans, and the spans: doc_id, text, removed array<(start, stop)>.

    Spans belong to rows of their doc_id and text_id, so rows without an id, or with the same, lose only their
    own. Documents that lose nothing keep their text as it is, null included; an empty table stays empty.
    """
    spans_of = removed.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("removed"))
    lists = spans_of.withColumnsRenamed({"doc_id": "of_id", "text_id": "of_text"})
    joined = _named(docs).join(lists, F.expr("text_id = of_text AND doc_id <=> of_id"), "left")
    kept = (
        "aggregate(removed, named_struct('s', '', 'at', 0), (acc, r) -> named_struct('s', concat(acc.s, substr(text, acc.at + 1, greatest(r.start - acc.at, 0))), "
        "'at', greatest(r.stop, acc.at)), acc -> concat(acc.s, substr(text, acc.at + 1)))"
    )
    return joined.selectExpr("doc_id", f"CASE WHEN removed IS NULL OR text IS NULL THEN text ELSE {kept} END AS text", "coalesce(removed, array()) AS removed")
