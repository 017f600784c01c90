"""Quality rules: counts over each whole text, and lines that too many documents of a host share.

Lines are normalised (ASCII letters in lower case, runs of white space as one space) and hashed; for each host and line the
distinct documents that hold it are counted. A line of more than `most` documents is removed from all of them, and a document is
rejected as depleted if that leaves it less than `least_share` of its words or fewer than `least_words`. Where only copies bring a line above
the limit (`most` distinct texts or fewer hold it), the document of the smallest id with each text keeps it, so that a group of copies leaves one.
Hashes and counts are shuffled; texts are once, in `cleaned`, to meet what is removed from them, by the same plan at every size.

Defined cases: a null text has no words and fails the base rules; null is a host of its own; a null doc_id stays
null and is a document for each text (the first of a text's copies only where none has an id); rows that repeat an id, a host and a text are one document and share
their verdict; rows of one id with different texts are documents of their own; empty and white lines are neither counted nor removed; a very
long text is one row, held whole; an empty table gives no rows; columns with names like those used here are left alone by `cleaned`, which
gives kept rows with all their columns (and `n_chars`, if there, counted anew where lines went).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialise, raw, small

SYMBOLS = b"#*$%&|<>"  # fixed value
STATS = "doc_id long, host string, text_hash long, mark long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, line_hashes array<long>, line_words array<int>"
NAMES = [x.split()[0] for x in STATS.split(", ")]
KEY = ("doc_id", "mark")  # of a document; the mark is a hash of id, host and text


def line_hash(words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words).lower()) - (1 << 63)


def repeated(words: list[bytes], width: int = 5) -> int:
    """How many words are in windows of `width` words that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    code = ids[:n]
    for k in range(1, width):  # exact: pairs are numbered again before they could overflow
        pair = code * len(number) + ids[k : k + n]
        code = np.unique(pair, return_inverse=True)[1] if k < width - 1 else pair
    _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
    again = count[inverse] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(again), 1)
    np.add.at(edges, np.flatnonzero(again) + width, -1)
    return int((np.cumsum(edges) > 0).sum())


def measure(text: bytes) -> tuple:
    words = text.split()
    joined = b"".join(words)
    seen, n_dup, hashes, counts = set(), 0, [], []
    for line in text.split(b"\n"):
        own = line.split()
        if own:
            n_dup += line in seen
            seen.add(line)
            hashes.append(line_hash(own))
            counts.append(len(own))
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    return len(words), chars, symbols, n_dup, repeated(words), hashes, counts


def mark_of(doc_id: Column, host: Column, text: Column) -> Column:
    return F.xxhash64(doc_id.cast("bigint"), F.coalesce(host.cast("string"), F.lit("")), host.isNull(), F.coalesce(text.cast("string"), F.lit("")))


def statistics(docs: DataFrame, host: str = "source") -> DataFrame:
    """A row per document, with the hashes and word counts of its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 4 << 20):
            columns = list(zip(*map(measure, raw(b.column(4))), strict=True))
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))], NAMES)

    id_, site, text = F.col("doc_id").cast("bigint"), F.col(host).cast("string"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(id_.alias("doc_id"), site.alias("host"), F.xxhash64(text).alias("text_hash"), mark_of(id_, site, text).alias("mark"), text.alias("text")).mapInArrow(run, STATS)


def shared_lines(stats: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Lines that more than `most` documents of a host hold (host, line, few: whether that many texts or fewer do), and the
    documents that keep the lines of few texts (host, text_hash, first_id). A line is counted by text first, so one that a large part of a host holds is many groups."""
    lines = stats.select("host", "doc_id", "mark", "text_hash", F.explode(F.array_distinct("line_hashes")).alias("line")).distinct()
    texts = materialise(lines.groupBy("host", "line", "text_hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")), "rules-lines")
    found = texts.groupBy("host", "line").agg(F.sum("n").alias("n_documents"), (F.count("*") <= most).alias("few")).where(F.col("n_documents") > most)
    found = materialise(found.select("host", "line", "few"), "rules-shared")
    few = found.where("few").select(F.col("host").alias("of"), F.col("line").alias("held"))
    spared = texts.join(few, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("held")), "left_semi").select("host", "text_hash", "first_id").distinct()
    return found, spared


def verdicts(docs: DataFrame, host: str = "source", most: int = 25, least_share: float = 0.3, least_words: int = 10) -> DataFrame:
    """doc_id, host, mark, the counts, base_failed, removed (line hashes), removed_words, kept."""
    stats = materialise(statistics(docs, host), "rules-stats")
    shared, spared = shared_lines(stats, most)
    z = F.explode(F.arrays_zip("line_hashes", "line_words")).alias("z")
    lines = stats.select(*KEY, "host", "text_hash", z).select(*KEY, "host", "text_hash", F.col("z.line_hashes").alias("line"), F.col("z.line_words").alias("words"))
    shared = shared.select(F.col("host").alias("of"), F.col("line").alias("held"), "few")
    hit = lines.join(shared, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("held"))).drop("of", "held")
    first = spared.select(F.col("host").alias("of"), F.col("text_hash").alias("t"), "first_id", F.lit(True).alias("spared"))
    hit = hit.join(first, F.col("few") & F.col("host").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left")
    hit = hit.where("spared is null").groupBy(*KEY, "line").agg(F.sum("words").alias("words"))
    own = hit.groupBy(*KEY).agg(F.collect_list("line").alias("removed"), F.sum("words").alias("gone"))
    # rows that repeat a document are one group above, so their counts are of all their rows
    again = stats.groupBy(*KEY).agg(F.count("*").alias("copies")).where("copies > 1")
    for other, names in ((own, ("removed", "gone")), (again, ("copies",))):
        other = other.select(*names, F.col("doc_id").alias("o_id"), F.col("mark").alias("o_mark"))
        stats = stats.join(other, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("mark") == F.col("o_mark")), "left").drop("o_id", "o_mark")
    gone = F.coalesce(F.floor(F.col("gone") / F.coalesce("copies", F.lit(1))), F.lit(0)).cast("bigint")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & ((left < least_words) | (left < least_share * F.col("n_words")))
    out = stats.withColumn("removed_words", gone).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~depleted)
    return out.select(*KEY, "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"), "removed_words", "kept")


def cleaned(docs: DataFrame, host: str = "source", **options) -> DataFrame:
    """The kept documents, without their shared lines, in the columns of `docs`. Verdicts other than to keep a text as it is meet the texts
    in a merge join on the document's key, whatever their number."""
    names = list(docs.columns)
    given = [f"rules_{k}" for k in range(len(names))]  # no clash with other columns
    own = docs.toDF(*given)
    at, chars, last = names.index("text"), names.index("n_chars") if "n_chars" in names else None, len(names)
    id_, text, site = (F.col(given[names.index(c)]) for c in ("doc_id", "text", host))
    said = verdicts(docs, host, **options).where(~F.col("kept") | (F.size("removed") > 0))
    said = materialise(said.groupBy(*KEY).agg(F.first("kept").alias("kept"), F.first("removed").alias("removed")), "rules-verdicts")
    both = own.join(said.hint("merge"), (F.coalesce(id_.cast("bigint"), F.lit(0)) == F.coalesce("doc_id", F.lit(0))) & (mark_of(id_, site, text) == F.col("mark")), "left")
    both = both.where(F.coalesce("kept", F.lit(True))).select(*given, "removed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 4 << 20):
            removed = b.column(last).to_pylist()
            columns = list(b.columns[:-1])
            if any(removed):
                texts = columns[at].to_pylist()
                for k, gone in enumerate(removed):
                    if gone:
                        gone = set(gone)
                        texts[k] = "\n".join(x for x in texts[k].split("\n") if not (words := x.encode().split()) or line_hash(words) not in gone)
                columns[at] = pa.array(texts, columns[at].type)
                if chars is not None:
                    columns[chars] = pa.array([len(t) if gone else n for t, gone, n in zip(texts, removed, columns[chars].to_pylist(), strict=True)], columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return both.mapInArrow(run, docs.schema)
