"""Line dedup by overlapping three-line windows.

Consecutive lines are hashed three at a time; windows that occur more than once are found over all documents, and every
occurrence but the first is removed by merging the positions that such windows cover.

A caller may ask for more: a passage may also stand inside a long line, and with ``longest`` a line of more words is wrapped at
places that only its own words decide (a word whose hash is the least of its neighbours'); the same passage is then wrapped alike
wherever it stands, and windows of wrapped pieces are hashed besides those of three whole lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.llm.common import checkpointed, fresh, table

WINDOW = 3
RADIUS = 3  # a wrap stands before a word whose hash is the least among this many neighbours on either side
LONG = 12  # a choice for ``longest``: lines of more words are wrapped
FEWEST = 12  # words of a window of wrapped pieces, at least
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def windows(raw: bytes, fewest: int = FEWEST, longest: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Window hashes (signed), the first and last piece that each window covers, and where each piece starts and ends.

    A piece is a non-blank line or, of a line of more than ``longest`` words (None: of no line), a part of it. Windows of three
    whole lines come always; windows of three pieces that are not all whole lines from ``fewest`` words on (others have the hash
    0). All pieces with the blank lines between them cover the text.
    """
    none = np.zeros(0, np.int64)
    data = np.frombuffer(raw, dtype=np.uint8)
    n = len(data)
    space = SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    word_starts, word_ends = edges[::2], edges[1::2]
    if not len(word_starts):
        return none, none.reshape(0, 2), none, none
    line_starts = np.concatenate([[0], np.flatnonzero(data == 10) + 1])
    line = np.searchsorted(line_starts, word_starts, side="right") - 1
    length = word_ends - word_starts
    at = lambda k: data[np.maximum(word_ends - k, word_starts)].astype(np.uint64)
    h = (at(1) | at(2) << np.uint64(8) | at(3) << np.uint64(16) | data[word_starts].astype(np.uint64) << np.uint64(24) | length.astype(np.uint64) << np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    first_of_line = np.concatenate([[True], line[1:] != line[:-1]])
    cut = first_of_line.copy()
    long_lines = np.bincount(line)[line] > (len(line) if longest is None else longest)
    if long_lines.any():
        least = long_lines
        for k in range(1, RADIUS + 1):
            same = np.zeros(len(h), bool)
            same[k:] = line[k:] == line[:-k]  # false for the first words of a line: no wrap before them
            left, right = np.full(len(h), ~np.uint64(0)), np.full(len(h), ~np.uint64(0))
            left[k:][same[k:]] = h[:-k][same[k:]]
            right[:-k][same[k:]] = h[k:][same[k:]]
            least = least & same & (h < left) & (h <= right)
        cut |= least
    first = np.flatnonzero(cut)  # first word of each line or piece
    last = np.append(first[1:], len(cut)) - 1
    words = last - first + 1
    starts, stops = word_starts[first], word_ends[last]
    whole = first_of_line[first] & np.append(first_of_line[first[1:]], True)
    tidy = (stops - starts == np.add.reduceat(length, first) + words - 1) & (np.cumsum(space & (data != 32))[stops - 1] == np.cumsum(space & (data != 32))[starts])
    digest, view = xxhash.xxh64_intdigest, memoryview(raw)
    each = np.array([digest(view[a:b] if t else b" ".join(raw[a:b].split()), 7) for a, b, t in zip(starts.tolist(), stops.tolist(), tidy.tolist())], dtype=np.uint64)
    # a line reaches from its start (with what stands before its first word on that line) to the next one's
    spans = np.where(first_of_line[first], line_starts[line[first]], starts)
    ends = np.where(whole | np.append(first_of_line[first[1:]], True), np.append(line_starts[1:], n)[line[first]], np.append(spans[1:], n))
    opens = np.flatnonzero(first_of_line[first])  # the first piece of each line
    closes = np.append(opens[1:], len(each)) - 1
    found, covers = [none.view(np.uint64)], [none.reshape(0, 2)]
    if len(each) >= WINDOW:
        counts = (words[:-2] + words[1:-1] + words[2:] >= fewest) | (whole[:-2] & whole[1:-1] & whole[2:])
        at = np.arange(len(each) - 2)
        found.append(np.where(counts, np.maximum(mixed(each), np.uint64(1)), np.uint64(0))), covers.append(np.stack([at, at + 2], 1))
    wrapped = opens < closes
    if len(opens) >= WINDOW and wrapped.any():
        lines = each[opens]
        lines[wrapped] = [digest(b" ".join(raw[a:b].split()), 7) for a, b in zip(starts[opens[wrapped]].tolist(), stops[closes[wrapped]].tolist())]
        some = np.flatnonzero(wrapped[:-2] | wrapped[1:-1] | wrapped[2:])
        found.append(np.maximum(mixed(lines)[some], np.uint64(1))), covers.append(np.stack([opens[some], closes[some + 2]], 1))
    return np.concatenate(found).view(np.int64), np.concatenate(covers), spans, ends


def mixed(each: np.ndarray) -> np.ndarray:
    """The hash of each three consecutive hashes, in their order."""
    out = each[:-2] * np.uint64(0x9E3779B97F4A7C15)
    out = ((out ^ out >> np.uint64(31)) + each[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F)
    out = ((out ^ out >> np.uint64(29)) + each[2:]) * np.uint64(0x165667B19E3779F9)
    return out ^ out >> np.uint64(32)


def strip(raw: bytes, places: list[int], fewest: int = FEWEST, longest: int | None = None) -> tuple[str, int]:
    """A text without the pieces that windows at ``places`` cover, and how many pieces that were."""
    _, covers, starts, ends = windows(raw, fewest, longest)
    gone = sorted({i for place in places for i in range(covers[place][0], covers[place][1] + 1)})
    out, at = [], 0
    for i in gone:
        out.append(raw[at : starts[i]])
        at = ends[i]
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "replace"), len(gone)


def repeated_places(docs: DataFrame, text: str, doc_id: str, fewest: int, longest: int | None, most_broadcast: int) -> DataFrame:
    """(id, text_hash, places): per document, the windows that occurred before, in the order of id, text hash and place.

    Rows with the same id and text are one document.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                found = [windows((t or "").encode("utf-8", "replace"), fewest, longest)[0] for t in batch.column(2).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(h) for h in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "text_hash", "hashes"])

    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    hashed = checkpointed(rows.mapInArrow(run, f"id {kind}, text_hash long, hashes array<long>").filter("size(hashes) > 0"))
    again = checkpointed(hashed.select(F.explode("hashes").alias("h")).filter("h <> 0").groupBy("h").count().filter("count > 1").select("h"))
    if again.count() <= most_broadcast:
        again = F.broadcast(again)
    each = hashed.select("id", "text_hash", F.posexplode("hashes").alias("place", "h")).filter("h <> 0").join(again, "h").select("h", F.struct("id", "text_hash", "place").alias("spot"))
    first = each.groupBy("h").agg(F.min("spot").alias("first"))
    later = each.join(first, "h").filter("spot > first")
    return later.select("spot.*").groupBy("id", "text_hash").agg(F.collect_set("place").alias("places"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", fewest: int = FEWEST, longest: int | None = None, most_broadcast: int = 2_000_000) -> DataFrame:
    """``docs`` with repeated lines out of its texts, and a column ``n_removed`` (lines, long; a column of this name is replaced).

    A window of three consecutive non-blank lines (their words joined by single spaces) that occurred before, in an earlier
    document or higher up in the same one, is removed with all other such windows it overlaps; the first occurrence stays.
    Earlier means a smaller id (null ids first), then a smaller hash of the text, then a smaller place; rows that repeat both
    id and text are one document and stay alike. Blank lines stay. Texts of fewer than three lines, null and empty texts stay
    as they are. A text whose lines all occurred before becomes empty; its row stays. Windows of three whole lines are all there is,
    unless ``longest`` is given: a line of more words is then wrapped too, can lose a part, and counts by its pieces.
    """
    docs = docs.drop("n_removed")
    key, places = fresh(docs, "text_hash"), fresh(docs, "places")
    found = repeated_places(docs, text, doc_id, fewest, longest, most_broadcast)
    id_ = fresh(docs, "id_of_places")
    found = found.select(F.col("id").alias(id_), F.col("text_hash").alias(key), F.col("places").alias(places))
    own = fresh(docs, "own_hash")
    joined = docs.withColumn(own, F.xxhash64(text)).join(found.hint("shuffle_hash"), F.col(own).eqNullSafe(F.col(key)) & F.col(doc_id).eqNullSafe(F.col(id_)), "left").drop(id_, key, own)
    schema = docs.withColumn("n_removed", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts, removed = batch.column(text).to_pylist(), [0] * batch.num_rows
                for i, some in enumerate(batch.column(places).to_pylist()):
                    if some:
                        texts[i], removed[i] = strip(texts[i].encode("utf-8", "replace"), some, fewest, longest)
                columns = {n: batch.column(n) for n in batch.schema.names if n != places} | {text: pa.array(texts, pa.string()), "n_removed": pa.array(removed, pa.int64())}
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], names=[f.name for f in schema])

    return joined.mapInArrow(run, schema)


#: Windows of three lines over whole texts, for distinct ids.
OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, len(parts) AS n_lines, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), words AS (
  SELECT doc_id, i, line, n_lines, trim(regexp_replace(line, '[\x09-\x0D ]+', ' ', 'g'), ' ') AS w FROM lines
), numbered AS (
  SELECT doc_id, i, w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r FROM words WHERE w <> ''
), windows AS (
  SELECT doc_id, r, w || chr(10) || lead(w, 1) OVER o || chr(10) || lead(w, 2) OVER o AS three FROM numbered WINDOW o AS (PARTITION BY doc_id ORDER BY r)
), later AS (
  SELECT doc_id, r FROM (SELECT doc_id, r, row_number() OVER (PARTITION BY three ORDER BY doc_id, r) AS k FROM windows WHERE three IS NOT NULL) AS k WHERE k > 1
), gone AS (
  SELECT DISTINCT later.doc_id, later.r + d.d AS r FROM later, (VALUES (0), (1), (2)) AS d(d)
), kept AS (
  SELECT words.doc_id, string_agg(CASE WHEN gone.r IS NULL THEN line || CASE WHEN words.i < n_lines THEN chr(10) ELSE '' END ELSE '' END, '' ORDER BY words.i) AS text, count(gone.r) AS n_removed
  FROM words LEFT JOIN numbered ON words.doc_id = numbered.doc_id AND words.i = numbered.i
  LEFT JOIN gone ON numbered.doc_id = gone.doc_id AND numbered.r = gone.r
  GROUP BY words.doc_id
)
SELECT doc_id, n_removed, length(text) AS n_chars_kept, sha256(text) AS text_sha256 FROM kept
"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_removed, the kept text's length and SHA-256."""
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_removed", F.char_length("text").cast("long").alias("n_chars_kept"), F.sha2("text", 256).alias("text_sha256"))
