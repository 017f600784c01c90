"""Near-duplicates by SimHash fingerprints, found by meet-in-the-middle ball hashing.

Two fingerprints within `radius` bits have a midpoint within half the radius of both. So every distinct fingerprint
emits all its variants within half the radius (2,081 at radius 4), and those that emit the same variant meet. Any two
that meet are within the radius, so each is verified against and linked to the first one there: the work grows with the
fingerprints, however many of them are alike. Variants travel as packed arrays in buckets of bounded size, in rounds of
one part of them each, so that one part is on disk at a time.

A cheaper plan of the same kind is there for `blocks=3, keep=2`: of any four differing bits at most two are in the best two
of three blocks of bits, so the variants within one bit of each pair of blocks (131 in all) let the same pairs meet,
and a few others. Pairs are verified there, and where more than `crowd` meet, those go through the first plan.

Components of the links are found by large-star and small-star rounds over tables in the shared folder.

Defined cases: a text without words, or null, has fingerprint zero and is linked like any other; fewer words than a
shingle are one shingle; repeated rows are one class; a null doc_id is a document, but names no component unless all
of its ids are null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import lean, materialise, raw, remove, small, trim, uniform

SEED = 42  # fixed value
ENTRIES = 1_000_000  # variants in a bucket, about


def shingle_hashes(text: bytes, width: int = 4) -> list[int]:
    words = text.lower().split()
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(x + 1 for x in ends)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :], strict=False)]


def majority(hashes: list[int], step: int = 1 << 16) -> int:
    """The bits set in over half of the hashes."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), step):
        part = np.array(hashes[i : i + step], "<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0]) if hashes else 0


def fingerprints(docs: DataFrame, width: int = 4, mark: Column | None = None) -> DataFrame:
    """doc_id and fp, a long that holds the 64 bits; with `mark`, also that column (a long) of the documents."""
    names = ["doc_id", "fp", *(["mark"] if mark is not None else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 4 << 20):
            fps = np.array([majority(shingle_hashes(x, width)) for x in raw(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], names)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), *([mark.alias("mark")] if mark is not None else []))
    return rows.mapInArrow(run, ", ".join(f"{x} long" for x in names))


def plan(radius: int, blocks: int, keep: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """flips, masks and salts: variant k of x is (x ^ flips[k]) & masks[k], among those of the same salt."""
    edges = np.linspace(0, bits, blocks + 1).round().astype(int)
    half = -(-(radius * keep // blocks) // 2)
    rows = []
    for salt, chosen in enumerate(combinations(range(blocks), keep)):
        own = [b for k in chosen for b in range(edges[k], edges[k + 1])]
        mask = sum(1 << int(b) for b in own)
        rows += [(sum(1 << int(b) for b in flip), mask, salt) for n in range(half + 1) for flip in combinations(own, n)]
    return tuple(np.array(x, np.uint64) for x in zip(*rows, strict=True))


def variant(fps: np.ndarray, k: np.ndarray, of: tuple) -> np.ndarray:
    flips, masks, salts = of
    return uniform(((fps ^ flips[k]) & masks[k]) + salts[k] * np.uint64(0x9E3779B97F4A7C15))


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links as stars: members and the least member of each one's component, where they differ."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if (label == before).all():
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def syndromes(x: np.ndarray, rounds: int) -> np.ndarray:
    """A linear map of the 64 bits to the numbers below `rounds` (a power of two)."""
    out = np.zeros(len(x), np.uint64)
    for b in range(rounds.bit_length() - 1):
        mask = sum(1 << k for k in range(64) if k % rounds >> b & 1)
        out |= (np.bitwise_count(x & np.uint64(mask)).astype(np.uint64) & np.uint64(1)) << np.uint64(b)
    return out


def exchange(distinct: DataFrame, of: tuple, buckets: int, rounds: int = 1, now: int = 0) -> DataFrame:
    """bucket, fps, ks: the variants of every fingerprint, packed by bucket of their key; in a round, those of one syndrome.
    The map is linear, so a fingerprint's syndrome says which flips lead there, and no others are tried."""
    n = len(of[0])
    rows = max(1, 400_000 * rounds // n)
    classes = syndromes(of[0], rounds)
    flips = [np.flatnonzero(classes == c).astype(np.uint16) for c in range(rounds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 1 << 30, rows):
            own = b.column(0).to_numpy().view(np.uint64)
            need = syndromes(own, rounds) ^ np.uint64(now)
            parts = [(own[need == c], flips[c]) for c in range(rounds)]
            fps = np.concatenate([np.repeat(x, len(f)) for x, f in parts])
            ks = np.concatenate([np.tile(f, len(x)) for x, f in parts])
            at = (variant(fps, ks, of) >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(at, kind="stable")
            stops = np.searchsorted(at[order], np.arange(buckets + 1, dtype=np.uint64))
            fps, ks = fps[order], ks[order]
            full = [k for k in range(buckets) if stops[k] < stops[k + 1]]
            cut = lambda x: pa.array([x[stops[k] : stops[k + 1]].tobytes() for k in full], pa.binary())  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), cut(fps), cut(ks)], ["bucket", "fps", "ks"])

    tasks = max(1, buckets * ENTRIES // 5_000_000)
    return distinct.select("fp").repartition(tasks).mapInArrow(run, "bucket int, fps binary, ks binary")


def meet(packed: DataFrame, of: tuple, radius: int, crowd: int | None) -> DataFrame:
    """a, b: links (stars of each bucket's components). crowd: above so many, fingerprints come with b null instead; None:
    whoever meets is linked."""

    def run(table: pa.Table) -> pa.Table:
        lean()
        fps = np.frombuffer(b"".join(table["fps"].to_pylist()), np.uint64)
        keys = variant(fps, np.frombuffer(b"".join(table["ks"].to_pylist()), np.uint16), of)
        order = np.argsort(keys, kind="stable")
        keys, fps = keys[order], fps[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(first, len(keys)))
        run_of = np.repeat(np.arange(len(first)), sizes)
        a, b, crowded = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], np.zeros(0, np.uint64)
        if crowd is None:
            later = np.flatnonzero(np.arange(len(keys)) != first[run_of])
            one, other = fps[later], fps[first[run_of[later]]]
            near = np.bitwise_count(one ^ other) <= radius
            a.append(one[near])
            b.append(other[near])
        else:
            crowded = np.unique(fps[sizes[run_of] > crowd])
            at = np.flatnonzero((sizes[run_of] > 1) & (sizes[run_of] <= crowd))
            left = first[run_of[at]] + sizes[run_of[at]] - 1 - at  # members after this one
            for d in range(1, crowd):
                at = at[left >= d]
                left = left[left >= d]
                if not len(at):
                    break
                near = at[np.bitwise_count(fps[at] ^ fps[at + d]) <= radius]
                near = near[fps[near] != fps[near + d]]
                a.append(fps[near])
                b.append(fps[near + d])
        u, v = local_components(np.concatenate(a), np.concatenate(b))
        del keys, fps, order, run_of
        trim()
        return pa.table({"a": pa.array(np.concatenate([u, crowded]).view(np.int64)), "b": pa.array(v.view(np.int64)) if not len(crowded) else pa.array([*v.view(np.int64).tolist(), *[None] * len(crowded)], pa.int64())})

    return packed.groupBy("bucket").applyInArrow(run, "a long, b long")


def links(distinct: DataFrame, radius: int = 4, blocks: int = 1, keep: int = 1, crowd: int = 64, rounds: int = 8) -> DataFrame:
    """a, b: links that join any two of the distinct fingerprints (fp) within the radius, maybe through others."""
    if radius % 2:
        raise ValueError("the radius must be even, so that whoever meets in its middle is within it")
    if blocks == 1:
        return whole_links(distinct, radius, rounds)
    n = distinct.count()
    of = plan(radius, blocks, keep)
    packed = exchange(distinct, of, max(1, -(-n * len(of[0]) // ENTRIES)))
    found = materialise(meet(packed, of, radius, crowd), "simhash-links")
    crowded = materialise(found.where("b is null").select(F.col("a").alias("fp")).distinct(), "simhash-crowds")
    return found.where("b is not null").unionByName(whole_links(crowded, radius, rounds))


def whole_links(distinct: DataFrame, radius: int, rounds: int) -> DataFrame:
    """By the variants over all bits. They are dealt with in rounds, which bounds what lies on disk at a time."""
    of, n = plan(radius, 1, 1), distinct.count()
    buckets = max(1, -(-n * len(of[0]) // (rounds * ENTRIES)))
    found = [materialise(meet(exchange(distinct, of, buckets, rounds, now), of, radius, None), "simhash-links") for now in range(rounds if n else 1)]
    return reduce(DataFrame.unionByName, found).distinct()


def beside(rows: DataFrame, low: DataFrame, parts: int = 8) -> DataFrame:
    """`rows` (u, v) with m of the same u in `low`. Each u is dealt over `parts` tasks, as the centre of a star has very many rows."""
    given = low.select(F.col("u").alias("n"), "m", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    return rows.join(given, (F.col("u") == F.col("n")) & (F.pmod(F.xxhash64("v"), F.lit(parts)).cast("int") == F.col("part"))).drop("n", "part")


def components(edges: DataFrame, u: str = "a", v: str = "b") -> DataFrame:
    """node, root: for each node of the links but the roots, the least node that it reaches."""
    spark = edges.sparkSession
    edges = materialise(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u != v").distinct(), "stars")
    said = lambda x: tuple(x.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    state, old = said(edges), None
    while state != old and state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = beside(both, low).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = materialise(large, "stars")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        side = beside(large, low).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = materialise(side.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        for done in (edges, large):
            for path in {x.rpartition("/")[0] for x in done.inputFiles()}:
                remove(spark, path)
        edges, old, state = new, state, said(new)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def grouped(fps: DataFrame, least: Column, radius: int, **options) -> DataFrame:
    """`fps` with `first`: the smallest `least` that links reach."""
    distinct = materialise(fps.groupBy("fp").agg(F.min(least).alias("rep")), "simhash-distinct")
    roots = components(links(distinct, radius, **options))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    reps = rooted.groupBy("root").agg(F.min("rep").alias("first"))
    classes = materialise(rooted.join(reps, "root").select(F.col("fp").alias("of"), "first"), "simhash-classes")
    return fps.join(classes, F.col("fp") == F.col("of")).drop("of")


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4, **options) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that links reach."""
    fps = materialise(fingerprints(docs, width), "simhash")
    return grouped(fps, F.col("doc_id"), radius, **options).select("doc_id", "fp", F.col("first").alias("component_id"))


def one_of_each(docs: DataFrame, radius: int = 4, width: int = 4, **options) -> DataFrame:
    """One row of each component, in the columns of `docs`: of the smallest doc_id (null is the largest), then fingerprint,
    then hash of the text, then the other columns as JSON. Rows are told apart by doc_id and a 64-bit hash of doc_id and text, so an id on
    several texts, or none, stands for each of them alone; rows that repeat an id and a text are one document. Which stay is decided on
    these keys, and meets the texts in a merge join, whatever their number. No rows give no rows; columns of any name are kept."""
    mark = F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    fps = materialise(fingerprints(docs, width, mark), "simhash")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "mark")
    stay = grouped(fps, own, radius, **options).where(own == F.col("first"))
    stay = stay.groupBy(F.coalesce("doc_id", F.lit(0)).alias("key_id"), F.col("mark").alias("key_mark")).agg(F.count("*").alias("n"))
    stay = materialise(stay, "simhash-stay")

    def met(keys: DataFrame) -> DataFrame:
        fits = (F.coalesce(docs["doc_id"].cast("bigint"), F.lit(0)) == keys["key_id"]) & (F.xxhash64(docs["doc_id"].cast("bigint"), docs["text"].cast("string")) == keys["key_mark"])
        return docs.join(keys.hint("merge"), fits, "left_semi")

    out = met(stay.where("n = 1"))
    again = stay.where("n > 1")
    if again.limit(1).count():  # a document on several rows: one of them stays
        row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
        one = met(again).groupBy(F.col("doc_id").cast("bigint").alias("key_id"), mark.alias("key_mark")).agg(F.min_by(row, F.to_json(row)).alias("row"))
        out = out.unionByName(one.select("row.*"))
    return out
