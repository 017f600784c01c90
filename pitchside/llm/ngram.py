"""Language-model scores from a weighted backoff automaton of order 3 that is learnt from the corpus.

States are the root, one for each word that is a context, and one for each word pair that occurs `least_context` times or more. An arc of a state is a word
seen after it; its weight is the discounted, interpolated log-probability. A state's failure arc weighs what the discount freed and leads from a pair's state to
that of its last word, and from there to the root, which has an arc for each word and one for the unknown word (add-one). A text is read once from left to right; the state
that is carried is the longest of these that ends in the token just read, from that of the end token on: where it has no arc for a token, its failure
arcs are followed. All texts of a block are read side by side.

Counts cover all learnt documents, and every word and pair that they hold. Triples are counted after pairs that are states; a pair that occurs less often has none of its own
and is read in its last word's state. Texts are read once: each task writes blocks of word numbers to the shared folder. Each block sends its distinct words, then its distinct
pairs, then its distinct triples in packed arrays to buckets by hash, and gets back the totals of those only. Contexts that hold many of the tokens are dealt over
`salts` buckets. Numbers of words and pairs are those of their buckets and places there, so no task, and never the driver, holds the model or a list of buckets.

Defined cases: a null or empty text is the end token alone; a document with null doc_id is learnt from; repeated
rows count as often as they occur; with nothing to learn from, every token is unknown; a very long text is one block, held whole; an empty table gives no rows; other columns
are not read. The input should be a table: a task that is repeated must see the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import filesystem, materialise, raw, remove, shared_dir, small, uniform, write_file

END = xxhash.xxh64_intdigest(b"")  # no word is empty
BLOCK = 2_500_000  # tokens, or a text that has more
PLACES = 32  # bits of a number
PACKED = "block string, bucket int, a binary, n binary, b binary, c binary"
BACK = "block string, bucket int, a binary, n binary, b binary, c binary, number binary, contexts binary, mass binary, types binary, tokens long, distinct_words long"
COLUMNS = [x.split()[0] for x in BACK.split(", ")]


def pack(a: np.ndarray, rising: bool = False) -> bytes:
    """Unsigned numbers, byte plane by byte plane; of a rising array, the steps."""
    a = np.diff(a, prepend=np.uint64(0)) if rising else a
    return zstandard.compress(np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack(x: bytes | None, rising: bool = False) -> np.ndarray:
    if not x:
        return np.zeros(0, np.uint64)
    a = np.ascontiguousarray(np.frombuffer(zstandard.decompress(x), np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(a, dtype=np.uint64) if rising else a


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, ends included, and each text's number of them."""
    words = [x.lower().split() for x in texts]
    long = np.fromiter(map(len, words), np.int64, len(words)) + 1
    out = np.full(int(long.sum()), END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(long) - 1] = False
    out[inner] = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(words)), np.uint64, len(out) - len(words))
    return out, long


def before(items: np.ndarray, long: np.ndarray, start: int) -> np.ndarray:
    """Each token's predecessor; `start` for a text's first."""
    out = np.empty_like(items)
    out[1:] = items[:-1]
    out[np.cumsum(long) - long] = start
    return out


def places(keys: np.ndarray, sought: np.ndarray) -> np.ndarray:
    """searchsorted, for very many: in order, which reads memory in order."""
    order = np.argsort(sought)
    out = np.empty(len(sought), np.int64)
    out[order] = np.searchsorted(keys, sought[order])
    return out


def found(keys: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of `sought` are among the keys, and where."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(places(keys, sought), len(keys) - 1)
    hit = np.flatnonzero(keys[at] == sought)
    return hit, at[hit]


def arrays(*of: np.ndarray) -> bytes:
    parts = [zstandard.compress(np.ascontiguousarray(x).tobytes(), 1) for x in of]
    return b"".join([np.array([len(x) for x in parts], "<u8").tobytes(), *parts])


def read_arrays(data: bytes, kinds: tuple) -> list[np.ndarray]:
    sizes = np.frombuffer(data, "<u8", len(kinds)).astype(np.int64)
    ends = 8 * len(kinds) + np.cumsum(sizes)
    return [np.frombuffer(zstandard.decompress(data[b - n : b]), k) for n, b, k in zip(sizes.tolist(), ends.tolist(), kinds, strict=True)]


KINDS = ("<u8", "<u4", "<i8", "?", "<i8", "?")  # of a block: distinct words, each token's, lengths, held out, doc_ids, known


def spans(at: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The values of an ascending array, with where each begins and ends."""
    values, first = np.unique(at, return_index=True)
    if len(at):
        yield from zip(values.tolist(), first.tolist(), [*first[1:].tolist(), len(at)], strict=True)


def heads_of(u: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a sorted array, and the sums of n for each."""
    if not len(u):
        return u, n
    at = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
    return u[at], np.add.reduceat(n, at)


def put(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), *[pa.binary()] * 4)
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in PACKED.split(", ")])


def back(rows: list[dict]) -> pa.Table:
    kinds = (pa.string(), pa.int32(), *[pa.binary()] * 8, *[pa.int64()] * 2)
    return pa.table([pa.array([r.get(c) for r in rows], k) for c, k in zip(COLUMNS, kinds, strict=True)], names=COLUMNS)


def word_counts(docs: DataFrame, root: str, bits: int) -> DataFrame:
    """Writes the blocks; each block's distinct words with their learnt counts go to the bucket of their hash's first bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0

        def done() -> pa.RecordBatch:
            hashes, long, out, ids, known = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            words, inverse = np.unique(hashes, return_inverse=True)
            block = f"{TaskContext.get().partitionId():07d}-{n:05d}"
            write_file(f"{root}/blocks/{block}", arrays(words, inverse.astype("<u4"), long, out, ids, known))
            counts = np.bincount(inverse, weights=np.repeat(~out, long), minlength=len(words)).astype(np.uint64)
            at = (words >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(words), np.int32)
            return put([(block, k, pack(words[a:b], True), None, None, pack(counts[a:b])) for k, a, b in spans(at)])

        for batch in small(batches, 4 << 20):
            hashes, long = tokens(raw(batch.column(1)))
            ids = batch.column(0)
            held.append((hashes, long, batch.column(2).to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)))
            if sum(len(x[0]) for x in held) >= BLOCK:
                yield done()
                n += 1
        if held:
            yield done()

    return docs.mapInArrow(run, PACKED)


def numbers(bucket: int, buckets: int, many: np.ndarray) -> np.ndarray:
    """Numbers, from 1 on, for the places where `many` holds, in this bucket's share of all numbers; 0 elsewhere."""
    share = (1 << PLACES) // buckets
    if int(many.sum()) >= share:
        raise ValueError("more words or pairs than 32 bits can number")
    return np.where(many, np.cumsum(many) + bucket * share, 0).astype(np.uint64)


def word_totals(buckets: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        """A bucket's totals, for each block those of its words, with their numbers. A row without a block has the bucket's tokens and words."""
        parts = [unpack(x, True) for x in table["a"].to_pylist()]
        words, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.bincount(inverse, weights=np.concatenate([unpack(x) for x in table["c"].to_pylist()])).astype(np.uint64)
        bucket = table["bucket"][0].as_py()
        number = numbers(bucket, buckets, totals > 0)
        rows = [{"bucket": bucket, "tokens": int(totals.sum()), "distinct_words": int((totals > 0).sum())}]
        for block, at in zip(table["block"].to_pylist(), np.split(inverse, np.cumsum([len(x) for x in parts])[:-1]), strict=True):
            rows.append({"block": block, "bucket": bucket, "a": pack(words[at], True), "c": pack(totals[at]), "n": pack(number[at])})
        return back(rows)

    return run


def each_block(names: DataFrame, root: str, done: Callable, schema: str) -> DataFrame:
    """done(block, tokens' places among the block's words, predecessors, lengths, held out, doc_ids, known) for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, folder = filesystem(f"{root}/blocks")
        for batch in small(batches):
            for block in batch.column(0).to_pylist():
                with at.open_input_file(f"{folder}/{block}") as f:
                    words, inner, long, out, ids, known = read_arrays(f.read(), KINDS)
                inner = inner.astype(np.int64)
                yield done(block, inner, before(inner, long, int(np.searchsorted(words, np.uint64(END)))), long, out, ids, known)

    return names.mapInArrow(run, schema)


def context_counts(names: DataFrame, root: str, order: int, buckets: int, common: int, salts: int, rounds: int = 1, now_: int = 0) -> DataFrame:
    """Each block's distinct pairs (of a context's number and a word's), by context; those of common contexts are dealt over `salts` buckets each. In a round, the
    contexts of one remainder."""

    def done(block: str, inner: np.ndarray, last: np.ndarray, long: np.ndarray, out: np.ndarray, _ids: np.ndarray, _known: np.ndarray) -> pa.RecordBatch:
        _, totals, number = load(root, "words", block, 3)
        now = number[inner]
        prior, seen = number[last], totals
        if order == 3:
            prior, seen, number = pair_states(root, block, number, inner, last, long)
        mine = lambda x: (x > 0) & (uniform(x) % np.uint64(rounds) == now_) if rounds > 1 else x > 0
        fit = (now > 0) & mine(prior)
        pair = prior << np.uint64(32) | now
        teach = np.repeat(~out, long)
        pairs, counts = np.unique(pair[fit & teach], return_counts=True)
        others = np.unique(pair[fit & ~teach])
        others = others[np.isin(others, pairs, invert=True, assume_unique=True)]
        # every context is told, with or without pairs, so that its mass comes back; a common one to all its buckets
        live = np.flatnonzero(mine(number))
        live = live[np.argsort(number[live])]
        told, wide = number[live], seen[live] >= common
        keys = np.concatenate([pairs, others])
        is_wide = wide[np.searchsorted(told, keys >> np.uint64(32))]
        salt = np.where(is_wide, uniform(keys & np.uint64(0xFFFFFFFF)) % np.uint64(salts), np.uint64(0))
        keys = np.concatenate([keys, np.repeat(told[wide], salts) << np.uint64(32), told[~wide] << np.uint64(32)])  # no word has number 0
        salt = np.concatenate([salt, np.tile(np.arange(salts, dtype=np.uint64), int(wide.sum())), np.zeros(int((~wide).sum()), np.uint64)])
        counts = np.concatenate([counts.astype(np.uint64), np.zeros(len(keys) - len(pairs), np.uint64)])
        ordered = np.argsort(keys, kind="stable")  # of runs that are in order
        keys, salt, counts = keys[ordered], salt[ordered], counts[ordered]
        u = keys >> np.uint64(32)
        bucket = (uniform(u + salt * np.uint64(0xD1B54A32D192ED03)) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int32)
        ordered = np.argsort(bucket, kind="stable")
        u, v, counts, bucket = u[ordered], keys[ordered] & np.uint64(0xFFFFFFFF), counts[ordered], bucket[ordered]
        rows = []
        for k, a, b in spans(bucket):
            own = v[a:b] > 0
            heads, each = heads_of(u[a:b], own.astype(np.uint64))
            rows.append((block, k, pack(heads, True), pack(each), pack(v[a:b][own]), pack(counts[a:b][own])))
        return put(rows or [(block, 0, *[pack(np.zeros(0, np.uint64))] * 4)])  # each block gets a file

    return each_block(names, root, done, PACKED)


def pair_states(root: str, block: str, number: np.ndarray, inner: np.ndarray, last: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of the pair state that each token is read in (0: none), and totals and numbers of the block's pairs. A text's first token is read in no pair's."""
    keys, totals, pairs, *_ = load(root, "pairs", block, 6)
    earlier = np.zeros(len(inner), np.int64)
    earlier[1:] = last[:-1]
    hit, at = found(keys, number[earlier] << np.uint64(32) | number[last])
    state = np.zeros(len(inner), np.uint64)
    state[hit] = pairs[at]
    state[np.cumsum(long) - long] = 0
    return state, totals, pairs


def context_totals(least: int, buckets: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        """A bucket's pairs, for each block those that it has, with numbers for those seen `least` times or more; and its contexts' mass and types."""
        heads, each, v, c = ([unpack(x, k == "a") for x in table[k].to_pylist()] for k in "anbc")
        keys = [np.repeat(x, n.astype(np.int64)) << np.uint64(32) | y for x, n, y in zip(heads, each, v, strict=True)]
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(inverse, weights=np.concatenate(c), minlength=len(distinct)).astype(np.uint64)
        number = numbers(table["bucket"][0].as_py(), buckets, totals >= least) if least else np.zeros(len(distinct), np.uint64)
        kept = totals > 0
        contexts, at = np.unique(distinct[kept] >> np.uint64(32), return_inverse=True)
        mass = np.bincount(at, weights=totals[kept], minlength=len(contexts)).astype(np.uint64)
        types = np.bincount(at, minlength=len(contexts)).astype(np.uint64)
        rows = []
        for block, at, mine in zip(table["block"].to_pylist(), np.split(inverse, np.cumsum([len(x) for x in keys])[:-1]), heads, strict=True):
            at = at[kept[at]]
            own = np.isin(contexts, mine, assume_unique=True)
            u, n = heads_of(distinct[at] >> np.uint64(32), np.ones(len(at), np.uint64))
            rows.append({"block": block, "a": pack(u, True), "n": pack(n), "b": pack(distinct[at] & np.uint64(0xFFFFFFFF)), "c": pack(totals[at]), "number": pack(number[at]) if least else None, "contexts": pack(contexts[own], True), "mass": pack(mass[own]), "types": pack(types[own])})
        return back(rows)

    return run


def store(rows: DataFrame, root: str, kind: str) -> None:
    """A file per block of what came back to it."""

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        read = lambda name, rising=False: [unpack(x, rising) for x in table[name].to_pylist()]
        if kind == "words":
            keys, rest = np.concatenate(read("a", True)), [np.concatenate(read("c")), np.concatenate(read("n"))]
        else:
            keys = np.concatenate([np.repeat(u, n.astype(np.int64)) << np.uint64(32) | v for u, n, v in zip(read("a", True), read("n"), read("b"), strict=True)])
            rest = [np.concatenate(read("c")), np.concatenate(read("number")) if kind == "pairs" else np.zeros(0, np.uint64)]
        order = np.argsort(keys, kind="stable")
        found_ = [np.zeros(0, np.uint64) if kind == "words" else keys[order], *(x[order] if len(x) else x for x in rest)]  # a block knows its words
        if kind != "words":  # the parts of a common context are summed
            contexts, inverse = np.unique(np.concatenate(read("contexts", True)), return_inverse=True)
            found_ += [contexts, *(np.bincount(inverse, weights=np.concatenate(read(x)), minlength=len(contexts)).astype(np.uint64) for x in ("mass", "types"))]
        parts = [pack(x, k in (0, 3)) for k, x in enumerate(found_)]
        write_file(f"{root}/{kind}/{block}", b"".join([np.array([len(x) for x in parts], "<u8").tobytes(), *parts]))
        return pa.table({"block": [block]})

    materialise(rows.where("block is not null").groupBy("block").applyInArrow(run, "block string"), f"ngram-{kind}")


def load(root: str, kind: str, block: str, n: int) -> list[np.ndarray]:
    at, folder = filesystem(f"{root}/{kind}")
    with at.open_input_file(f"{folder}/{block}") as f:
        data = f.read()
    ends = 8 * n + np.cumsum(sizes := np.frombuffer(data, "<u8", n).astype(np.int64))
    return [unpack(data[b - k : b], i in (0, 3)) for i, (k, b) in enumerate(zip(sizes.tolist(), ends.tolist(), strict=True))]


class Automaton:
    """The states and arcs that a block can meet."""

    def __init__(self, words: list[np.ndarray], pairs: list[np.ndarray], triples: list[np.ndarray], tokens: int, distinct: int, discount: float):
        """words: hashes, totals, numbers. pairs: keys (numbers of both words), totals, numbers of those that are states, and numbers, mass and types of the
        words that are contexts. triples: keys (numbers of a pair and a word), totals, and numbers, mass and types of the pairs that are."""
        _, totals, self.number = words
        self.totals, self.discount = totals.astype(np.float64), discount
        self.root = (self.totals + 1) / (tokens + distinct + 1)  # the root's arc for each word
        self.pair_keys, counts, self.pair_number, *contexts = pairs
        self.pair_counts = counts.astype(np.float64)
        self.triple_keys, counts, _, *pair_contexts = triples
        self.triple_counts = counts.astype(np.float64)
        self.fail = self.freed(self.number, self.totals, *contexts)  # what a state's failure arc weighs
        self.pair_fail = self.freed(self.pair_number, self.pair_counts, *pair_contexts)

    def freed(self, number: np.ndarray, totals: np.ndarray, contexts: np.ndarray, mass: np.ndarray, types: np.ndarray) -> np.ndarray:
        out = np.ones(len(number))
        if len(contexts):
            own = np.flatnonzero(number)
            at = own[np.argsort(number[own])]
            at = at[np.searchsorted(number[at], contexts)]
            out[at] = 1 - (mass - self.discount * types) / totals[at]
        return out

    def walk(self, at: np.ndarray, last: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's log10-probability, that of the root alone, and its number of known tokens. at: the tokens' words, last: their predecessors'."""
        now, prior = self.number[at], self.number[last]
        chance = self.fail[last] * self.root[at]
        may = np.flatnonzero((now > 0) & (prior > 0))
        key = prior[may] << np.uint64(32) | now[may]
        hit, arc = found(self.pair_keys, key)
        chance[may[hit]] += (self.pair_counts[arc] - self.discount) / self.totals[last[may[hit]]]
        # the pair that a token ends is the state that the next one is read in
        state = np.full(len(at) + 1, -1, np.int64)
        state[may[hit] + 1] = np.where(self.pair_number[arc] > 0, arc, -1)
        starts = np.cumsum(long) - long
        state[starts] = -1
        own = np.flatnonzero(state[: len(at)] >= 0)
        pair = state[own]
        chance[own] *= self.pair_fail[pair]
        hit, arc = found(self.triple_keys, self.pair_number[pair] << np.uint64(32) | now[own])
        chance[own[hit]] += (self.triple_counts[arc] - self.discount) / self.pair_counts[pair[hit]]
        sums = [np.add.reduceat(np.log10(x), starts) for x in (chance, self.root[at])]
        return *sums, np.add.reduceat((self.totals[at] > 0).astype(np.int64), starts)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scores(docs: DataFrame, held_out: F.Column, least_context: int = 2, discount: float = 0.75, salts: int = 16, bits: int | None = None, rounds: int = 3) -> DataFrame:
    """Every document's score by the model that the documents not held out give. least_context: how often a pair that is a state occurs at least. bits: words are
    counted in 2**bits buckets, by default one for each 4 MB that Spark takes the input to have (2**14 at most). rounds: triples are counted in so many rounds of contexts, which bounds what lies on disk at a time."""
    spark = docs.sparkSession
    root = shared_dir(spark, "ngram")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    if bits is None:
        size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        bits = min(14, max(1, (size >> 22).bit_length()))
    words = materialise(word_counts(rows, root, bits).groupBy("bucket").applyInArrow(word_totals(1 << bits), BACK), "ngram-words")
    n_tokens, n_words = (x or 0 for x in words.where("block is null").agg(F.sum("tokens"), F.sum("distinct_words")).first())
    store(words, root, "words")
    names = materialise(words.where("block is not null").select("block").distinct(), "ngram-blocks")
    for path in {x.rpartition("/")[0] for x in words.inputFiles()}:
        remove(spark, path)
    names = names.repartitionByRange(max(1, names.count()), "block")  # a block a task
    buckets = max(2 * salts if n_tokens > 2 * BLOCK else 4, n_tokens // 1_500_000 + 1)
    common = max(1, n_tokens // (4 * buckets))
    store(context_counts(names, root, 2, buckets, common, salts).groupBy("bucket").applyInArrow(context_totals(max(1, least_context), buckets), BACK), root, "pairs")
    for k in range(rounds):
        store(context_counts(names, root, 3, buckets, common, salts, rounds, k).groupBy("bucket").applyInArrow(context_totals(0, buckets), BACK), root, f"triples{k}")

    def triples(block: str) -> list[np.ndarray]:
        keys, counts, numbers_, *contexts = (np.concatenate(x) for x in zip(*(load(root, f"triples{k}", block, 6) for k in range(rounds)), strict=True))
        order = np.argsort(keys, kind="stable")
        return [keys[order], counts[order], numbers_, *contexts]

    def done(block: str, inner: np.ndarray, last: np.ndarray, long: np.ndarray, out: np.ndarray, ids: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
        model = Automaton(load(root, "words", block, 3), load(root, "pairs", block, 6), triples(block), n_tokens, n_words, discount)
        score, base, n_known = model.walk(inner, last, long)
        columns = [pa.array(ids, mask=~known), pa.array(out), pa.array(long), pa.array(n_known), pa.array(np.full(len(long), n_tokens)), pa.array(base), pa.array(score)]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SCORES.split(", ")])

    return each_block(names, root, done, SCORES)
