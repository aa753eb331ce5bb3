"""MinHash near-dedup: a multi-index Hamming join of b-bit signatures, confirmed on full sets."""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, blocks, mixed, per_batch, staged, staged_rows, table, utf8
from .components import contracted, told


@dataclass(frozen=True)
class Scheme:
    """Signatures of ``chunks`` x ``width`` values of ``bits`` bits, and what may differ.

    By pigeonhole, two signatures that differ in at most ``guaranteed`` values agree in one
    chunk up to ``errors`` values. Each way to leave out ``errors`` values of a chunk is one
    key, so such a pair shares a key. Beyond the guarantee, a pair of similarity s shares no
    key with probability (1 - P(at most ``errors`` of ``width`` differ)) ** chunks, which is
    1.6e-6 for s = 0.8 and less above. Pairs that share a key by chance need the other
    ``width - errors`` values to agree; more values per key keep keys rare in a larger corpus.
    """

    shingle: int = 5
    threshold: int = 80  # per cent
    chunks: int = 10
    width: int = 5
    errors: int = 1
    bits: int = 16
    #: Candidates whose signatures differ in more values are no links: at similarity 0.8 one
    #: pair in a million differs in 26 of 50.
    far: int = 25

    @property
    def values(self) -> int:
        return self.chunks * self.width

    @property
    def guaranteed(self) -> int:
        return self.chunks * (self.errors + 1) - 1


#: Links of the query: two words per shingle, similarity 0.8.
TWO_WORDS = Scheme(shingle=2)
#: Star rounds go on while one in so many members of unsettled keys gets connected by a round.
STAR_GAIN = 20
#: Centres that a star round draws for each key.
STAR_CENTERS = 3
#: Members of a key that are held at once when the rest of it is compared.
BLOCK = 4096
#: Ids are sent to all tasks up to this size, at 16 bytes each.
BROADCAST_BYTES = 16 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15 | 1


_KNOWN_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64."""
    if len(_KNOWN_POWERS.get(base, ())) < n:
        out = np.full(max(n, 2 * BLOCK_BYTES), base, dtype=np.uint64)
        out[0] = 1
        _KNOWN_POWERS[base] = np.multiply.accumulate(out)
    return _KNOWN_POWERS[base][:n]


def word_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words per text) of texts that lie one after the other in ``raw``.

    A word's hash is a polynomial in its bytes, with A-Z as a-z, taken from running sums
    over all bytes; texts end words as white space does.
    """
    docs, n = len(at) - 1, len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(docs, np.int64)
    ink = ~_SPACE[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[at] = True
    before = np.concatenate(([False], ink[:-1])) & ~edge[:n]
    after = np.concatenate((ink[1:], [False])) & ~edge[1:]
    start, stop = np.flatnonzero(ink & ~before), np.flatnonzero(ink & ~after) + 1
    powers, inverse = _powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * powers, dtype=np.uint64)))
    hashes = mixed((sums[stop] - sums[start]) * inverse[start])
    return hashes, np.diff(np.searchsorted(start, at))


def _words(raw: np.ndarray, at: np.ndarray, size: int = BLOCK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """word_hashes of a block; one very long text is read in slices cut at white space."""
    if len(at) > 2 or len(raw) <= size:
        return word_hashes(raw, at)
    found, start = [], 0
    while start < len(raw):
        stop = min(start + size, len(raw))
        while stop < len(raw):
            spaces = np.flatnonzero(_SPACE[raw[stop : stop + size]])
            if len(spaces):
                stop += int(spaces[0])
                break
            stop = min(stop + size, len(raw))
        found.append(word_hashes(raw[start:stop], np.array([0, stop - start]))[0])
        start = stop
    words = np.concatenate(found)
    return words, np.array([len(words)])


def shingle_sets(column: pa.Array, k: int):
    """Per block of texts: (from, to, list of sorted arrays of distinct shingle hashes)."""
    raw, at = utf8(column)
    for start, stop in blocks(at):
        words, counts = _words(raw[at[start] : at[stop]], at[start : stop + 1] - at[start])
        ends = np.cumsum(counts)
        joined = words
        for i in range(1, k):  # hash of the k words from here; those that leave the text go below
            joined = joined[: len(words) - i] * np.uint64(0xD6E8FEB86659FD93) + words[i:]
        joined = mixed(joined) if len(words) >= k else joined[:0]
        sets = []
        for stop_at, n in zip(ends, counts):
            if n >= k:
                own = joined[stop_at - n : stop_at - k + 1].copy()
                own.sort()
                sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
            elif n:  # fewer words: the whole sequence, told apart from shingles by its length
                whole = np.full(1, n, dtype=np.uint64)
                for i in range(stop_at - n, stop_at):
                    whole = mixed(whole * np.uint64(0xD6E8FEB86659FD93) + words[i : i + 1])
                sets.append(whole)
            else:
                sets.append(np.zeros(0, np.uint64))
        yield start, stop, sets


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(1997).integers(0, 2**32, (2, n), dtype=np.uint64).astype(np.uint32)
    return drawn[0], drawn[1] | np.uint32(1)


def signatures(sets: list[np.ndarray], scheme: Scheme) -> np.ndarray:
    """One row of b-bit minima per set; sets must not be empty."""
    out = np.empty((len(sets), scheme.values), dtype=np.uint16)
    if not sets:
        return out
    x = np.concatenate(sets)
    x = (x ^ (x >> np.uint64(32))).astype(np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    for i, (salt, factor) in enumerate(zip(*_seeds(scheme.values))):
        h = (x ^ salt) * factor
        h ^= h >> np.uint32(16)
        h *= np.uint32(0x7FEB352D)
        out[:, i] = np.minimum.reduceat(h, starts) & np.uint32((1 << scheme.bits) - 1)
    return out


def _choices(scheme: Scheme) -> list[list[int]]:
    """The values each key of a signature is made of: its slots, in order."""
    kept = scheme.width - scheme.errors
    return [
        [chunk * scheme.width + i for i in choice]
        for chunk in range(scheme.chunks)
        for choice in itertools.combinations(range(scheme.width), kept)
    ]


def keys(signature: np.ndarray, scheme: Scheme) -> np.ndarray:
    """All keys of each signature: every chunk with every choice of values left out."""
    out = []
    for slot, columns in enumerate(_choices(scheme)):
        key = np.full(len(signature), slot + 1, dtype=np.uint64)
        for column in columns:
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, column].astype(np.uint64))
        out.append(key)
    return np.stack(out, axis=1).view(np.int64)


def sketches(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, n_shingles, cls (digest of the set) and sig (signature) of every row; null if empty."""

    def run(batch: pa.RecordBatch):
        for start, stop, sets in shingle_sets(batch.column("text"), scheme.shingle):
            full = [i for i, s in enumerate(sets) if len(s)]
            rows = signatures([sets[i] for i in full], scheme)
            cls, sig = [None] * len(sets), [None] * len(sets)
            for i, row in zip(full, rows):
                cls[i], sig[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), row.tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(start, stop - start), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(cls, pa.binary()), pa.array(sig, pa.binary()),
            ], ["doc_id", "n_shingles", "cls", "sig"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        per_batch(run), "doc_id long, n_shingles long, cls binary, sig binary"
    )


def _keyed(classes: DataFrame, scheme: Scheme) -> DataFrame:
    """(key, slot, id) for every key of every class."""

    def run(batch: pa.RecordBatch):
        rows = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint16).reshape(-1, scheme.values)
        for at in range(0, len(rows), 2048):
            found = keys(rows[at : at + 2048], scheme)
            ids = batch.column("id").slice(at, len(found)).to_numpy()
            slots = np.tile(np.arange(found.shape[1], dtype=np.int32), len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.ravel()), pa.array(slots), pa.array(np.repeat(ids, found.shape[1]))], ["key", "slot", "id"]
            )

    return classes.select("id", "sig").mapInArrow(per_batch(run), "key long, slot int, id long")


def _side(classes: DataFrame, x: str) -> DataFrame:
    return classes.select(F.col("id").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("n").alias(f"n_{x}"))


def _beside(met: DataFrame, classes: DataFrame) -> DataFrame:
    """A row (x, y, sig_x, n_x) of each id x and each y of its list ``c``.

    An id meets its signature once, before its pairs are rows. Where ``met`` has components, there are ca and cb, the
    smaller and the larger one of the two.
    """
    rows = met.withColumnRenamed("id", "x").join(_side(classes, "x"), "x").withColumn("c", F.explode("c"))
    of = [f("c.component", "component").alias(name) for f, name in ((F.least, "ca"), (F.greatest, "cb"))]
    return rows.select("x", F.col("c.id").alias("y"), "sig_x", "n_x", *(of if "component" in met.columns else ()))


def _close(pairs: DataFrame, classes: DataFrame, scheme: Scheme) -> DataFrame:
    """(a, b), the smaller id first, and ca and cb if there are any, of the pairs whose set sizes and signatures allow a link."""
    names = ["a", "b", *(c for c in ("ca", "cb") if c in pairs.columns)]
    both = pairs.join(_side(classes, "y"), "y").withColumns({"a": F.least("x", "y"), "b": F.greatest("x", "y")})
    least, most = F.least("n_x", "n_y"), F.greatest("n_x", "n_y")

    def run(batch: pa.RecordBatch):
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, scheme.values) for c in ("sig_x", "sig_y"))
        near = pa.array((x != y).sum(axis=1) <= scheme.far)
        yield batch.select(names).filter(near)

    return both.filter(least * 100 >= most * scheme.threshold).select(*names, "sig_x", "sig_y").mapInArrow(
        per_batch(run), ", ".join(f"{c} long" for c in names)
    )


def full_sets(docs: DataFrame, ids: DataFrame, scheme: Scheme) -> DataFrame:
    """(id, shingles), stored, of the documents whose doc_id is in ``ids``.

    Ids that fit BROADCAST_BYTES are sent to the texts; more are joined by a shuffle.
    """

    def run(batch: pa.RecordBatch):
        for start, stop, sets in shingle_sets(batch.column("text"), scheme.shingle):
            at = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(start, stop - start), lists], ["id", "shingles"])

    ids, n = staged_rows(ids.distinct(), "near-ids")
    small = n * 16 <= BROADCAST_BYTES
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(ids) if small else ids, "id", "left_semi")
    return staged(rows.mapInArrow(per_batch(run), "id long, shingles array<long>"), "near-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs whose full sets reach the similarity: 100 |A and B| >= threshold |A or B|."""
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a"
    )
    shared = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - shared
    return both.filter(shared * 100 >= union * scheme.threshold).select(*pairs.columns)


def _open(buckets: DataFrame, labels: DataFrame, round_: int) -> DataFrame:
    """Rows of keys that hold more than one component, with each id's component.

    ``c`` has the centres that the round draws from all members of the key, told apart.
    """
    rows = buckets.select("key", "slot", "id").join(labels, "id", "left").select("key", "slot", "id", F.coalesce("component", "id").alias("component"))
    least = [F.xxhash64("id", F.lit(STAR_CENTERS * round_ + i)) for i in range(STAR_CENTERS)]
    drawn = [F.struct(*(F.min_by(c, h).alias(c) for c in ("id", "component"))) for h in least]
    several = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.array_distinct(F.array(*drawn)).alias("c"))
    return rows.join(several.filter("lo <> hi").select("key", "c"), "key")


def _with(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Open rows with the facts of their ids: an id meets its facts once, with all its keys in a list.

    A list has one entry for each key of a signature at most.
    """
    names = [c for c in rows.columns if c not in ("id", "component")]
    held = rows.groupBy("id").agg(F.first("component").alias("component"), F.collect_list(F.struct(*names)).alias("at"))
    return held.join(facts, "id").withColumn("at", F.explode("at")).select(
        *(f"at.{c}" for c in names), "id", "component", *(c for c in facts.columns if c != "id")
    )


def _met(rows: DataFrame) -> DataFrame:
    """(id, component, c) of open rows: the centres of other components that an id meets, each once.

    Keys of near copies draw the same few centres. A list has STAR_CENTERS entries for each key of
    an id at most.
    """
    others = F.filter("c", lambda c: c.component != F.col("component"))
    met = rows.select("id", "component", others.alias("c")).filter(F.size("c") > 0)
    return met.groupBy("id").agg(F.first("component").alias("component"), F.array_distinct(F.flatten(F.collect_list("c"))).alias("c"))


def _starred(
    members: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, scheme: Scheme
) -> tuple[DataFrame, int, DataFrame]:
    """(rows of keys that are open still, their number, labels) after star rounds.

    In a round some members of every open key are drawn as it is found open, and all members of other components
    that have a full set are compared with them. What a round leaves is examined otherwise.
    """
    round_ = 0
    while True:
        rows, left = staged_rows(_open(members, labels, round_), "near-open")
        if not left:
            return rows, left, labels
        pairs = staged(_close(_beside(_met(rows), classes), classes, scheme).distinct(), "near-pairs")
        more, n = staged_rows(confirmed(pairs, sets, scheme), "near-links")
        members, round_ = rows, round_ + 1
        if n:
            labels = contracted(labels, more.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        if n * STAR_GAIN <= left:
            return (*(staged_rows(_open(members, labels, round_).drop("c"), "near-open") if n else (rows.drop("c"), left)), labels)


def _slots(equal: np.ndarray, scheme: Scheme) -> np.ndarray:
    """The first key slot that each pair shares, from which of its values are equal."""
    out = np.full(len(equal), -1)
    for slot, columns in reversed(list(enumerate(_choices(scheme)))):
        out[equal[:, columns].all(axis=1)] = slot
    return out


def _flags(key, x, block, i, j, equal, scheme):
    """Emit for _compared: the rows of a key that may have a link which is this key's to find."""
    first = _slots(equal, scheme) == x["slot"][i]
    ids = np.unique(np.concatenate((x["id"][i[first]], block["id"][j[first]])))
    return [np.full(len(ids), key), ids]


def _exact(key, x, block, i, j, equal, scheme):
    """Emit for _compared: links by full sets; each pair is worked out under its first shared key only."""
    first = _slots(equal, scheme) == x["slot"][i]
    i, j = i[first], j[first]
    a, b = [], []
    for row in np.unique(i):
        others, own = j[i == row], x["shingles"][row]
        sets = [block["shingles"][o] for o in others]
        sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        shared = np.add.reduceat((own[at] == flat).astype(np.int64), np.concatenate(([0], np.cumsum(sizes)[:-1])))
        linked = others[shared * 100 >= (len(own) + sizes - shared) * scheme.threshold]
        a.append(np.minimum(x["id"][row], block["id"][linked]))
        b.append(np.maximum(x["id"][row], block["id"][linked]))
    return [np.concatenate(a), np.concatenate(b)] if a else [np.zeros(0, np.int64)] * 2


def _compared(rows: DataFrame, facts: DataFrame, scheme: Scheme, emit, schema: str) -> DataFrame:
    """Pairs of a key in different components whose signatures and sizes allow a link.

    ``rows`` has key, slot, id and component, ``facts`` id, n, sig and maybe shingles. Members outside
    a key's largest component are compared with all its members. These come in blocks of about
    BLOCK rows; a task holds one block while the others stream by. What leaves the task is
    what ``emit`` makes of the pairs: rows of keys, or confirmed links, never all pairs.
    """
    held = rows.groupBy("key", "component").agg(F.count("*").alias("k"))
    main = held.groupBy("key").agg(
        F.max_by("component", F.struct("k", "component")).alias("main"), F.ceil(F.sum("k") / BLOCK).cast("int").alias("cut")
    )
    columns = ["slot", "id", "component", *(c for c in facts.columns if c != "id")]
    place = lambda block, kind: F.struct(block.cast("int").alias("block"), F.lit(kind).alias("kind"))
    own = F.array(place(F.pmod(F.xxhash64("id"), "cut"), 0))
    every = F.transform(F.sequence(F.lit(0), F.col("cut") - 1), lambda block: place(block, 1))
    where = F.explode(F.when(F.col("component") != F.col("main"), F.concat(own, every)).otherwise(own))
    sized = _with(rows.join(staged(main, "near-main"), "key"), facts)
    names = [part.split()[0] for part in schema.split(", ")]

    def loaded(batch, start, stop):
        part = batch.slice(start, stop - start)
        out = {c: part.column(c).to_numpy() for c in ("slot", "id", "component", "n")}
        out["sig"] = np.frombuffer(b"".join(part.column("sig").to_pylist()), dtype=np.uint16).reshape(-1, scheme.values)
        if "shingles" in columns:
            flat, ends = part.column("shingles").flatten().to_numpy().view(np.uint64), np.cumsum(out["n"])
            out["shingles"] = [flat[e - k : e] for e, k in zip(ends, out["n"])]
        return out

    def close(x, block):
        step = max(1, 4_000_000 // block["sig"].size)
        for at in range(0, len(x["id"]), step):
            part = slice(at, at + step)
            near = (x["sig"][part, None, :] != block["sig"][None]).sum(axis=2) <= scheme.far
            near &= x["component"][part, None] != block["component"][None]
            small = np.minimum(x["n"][part, None], block["n"][None])
            near &= small * 100 >= np.maximum(x["n"][part, None], block["n"][None]) * scheme.threshold
            i, j = np.nonzero(near)
            if len(i):
                yield i + at, j

    def run(batches):
        now, parts, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, piece, kind = (batch.column(c).to_numpy() for c in ("key", "block", "kind"))
            change = (key[1:] != key[:-1]) | (piece[1:] != piece[:-1]) | (kind[1:] != kind[:-1])
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(key)]
            found = []
            for start, stop in zip(edges, edges[1:]):
                if (key[start], piece[start]) != now:
                    now, parts, block = (key[start], piece[start]), [], None
                x = loaded(batch, start, stop)
                if kind[start] == 0:
                    parts.append(x)
                elif parts:
                    if block is None:
                        block = {c: sum((p[c] for p in parts), []) if c == "shingles" else np.concatenate([p[c] for p in parts]) for c in x}
                    for i, j in close(x, block):
                        found.append(emit(key[start], x, block, i, j, x["sig"][i] == block["sig"][j], scheme))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(f)) for f in zip(*found)], names)

    shuffles = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = sized.withColumn("at", where).select("key", "at.block", "at.kind", *columns)
    lined = placed.repartition(shuffles, "key", "block").sortWithinPartitions("key", "block", "kind")
    return lined.mapInArrow(run, schema).distinct()


def link_labels(docs: DataFrame, classes: DataFrame, scheme: Scheme) -> DataFrame:
    """(id, component) of every class that confirmed links connect with a smaller one.

    Members of a key are not all compared with each other. First each is compared with the
    smallest id of its key, then with other members, drawn anew in each round while that
    connects many; a large group of near copies is mostly connected by that. Then
    signatures single out the members that may have a link to another component still, and
    only their full sets are read. At last, what a key still holds beside its largest
    component is compared with every member of other components. So each pair that shares a
    key is examined, or connected already. Labels are kept from round to round and new links
    only merge them. Texts are read three times in all.
    """
    keyed = _keyed(classes, scheme)
    shared = keyed.groupBy("key").agg(F.min("id").alias("center"), F.count("*").alias("n")).filter("n > 1")
    buckets = staged(keyed.join(shared, "key"), "near-keys")
    met = buckets.filter("id <> center").groupBy("id").agg(F.collect_set(F.struct(F.col("center").alias("id"))).alias("c"))
    pairs = staged(_close(_beside(met, classes), classes, scheme), "near-pairs")  # a centre is smaller, so a pair is met once
    sets = full_sets(docs, pairs.select(F.col("a").alias("id")).union(pairs.select("b")), scheme)
    labels = contracted(None, confirmed(pairs, sets, scheme))

    larger = buckets.filter("n > 2")  # a pair alone on its key is done
    rows, n, labels = _starred(larger, labels, classes, sets, scheme)
    if not n:
        return labels
    flags = _compared(rows, classes.select("id", "sig", "n"), scheme, _flags, "key long, id long")
    flagged, n = staged_rows(flags, "near-flagged")
    if not n:
        return labels
    members = staged(rows.select("key", "slot", "id").join(flagged, ["key", "id"]), "near-members")
    sets = full_sets(docs, members.select("id"), scheme)
    rows, n, labels = _starred(members, labels, classes, sets, scheme)
    if not n:
        return labels
    full = classes.select("id", "sig").join(sets, "id").select("id", "sig", F.size("shingles").cast("long").alias("n"), "shingles")
    last = staged(_compared(rows, full, scheme, _exact, "a long, b long"), "near-last")
    return contracted(labels, told(last, labels))


def near_duplicates(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; whole texts.

    Words are runs of characters other than ASCII white space, A-Z lower-cased. A document's
    set has its distinct runs of ``scheme.shingle`` words; with fewer words, the whole
    sequence; without words (null, empty or blank text) it is empty and linked with nothing.
    Sets are linked when their Jaccard similarity reaches the threshold, confirmed on full
    sets. component_id is the smallest doc_id reachable and kept says it is the row's own.

    Documents with equal sets are one class from the start, so copies cost one signature.
    Rows that share a doc_id are one document: a link of either is a link of both. A row
    with a null doc_id takes no part in links; its component_id is null and it is kept.
    An empty table gives an empty result; other columns are ignored.
    """
    rows = staged(sketches(docs, scheme), "near-sketches")
    known = rows.filter("cls is not null and doc_id is not null")
    per_class = known.groupBy("cls").agg(F.min("doc_id").alias("id"), F.min_by(F.struct("sig", "n_shingles"), "doc_id").alias("s"))
    classes = staged(per_class.select("cls", "id", "s.sig", F.col("s.n_shingles").alias("n")), "near-classes")
    # a doc_id on rows of several classes connects them
    torn = known.select("doc_id", "cls").distinct().groupBy("doc_id").agg(F.count("*").alias("k")).filter("k > 1")
    several, n = staged_rows(torn, "near-several")
    bridges = known.join(several, "doc_id").join(classes.select("cls", "id"), "cls").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    labels = link_labels(docs.filter("doc_id is not null"), classes, scheme)
    if n:
        labels = contracted(labels, told(bridges, labels))
    of_class = staged(classes.join(labels, "id", "left").select("cls", F.coalesce("component", "id").alias("of")), "near-labels")
    return rows.join(of_class, "cls", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("of", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _small_ids(ids: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Ids as they are stored, to be broadcast up to BROADCAST_BYTES, and their number."""
    stored, n = staged_rows(ids, name)
    return F.broadcast(stored) if n * 16 <= BROADCAST_BYTES else stored, n


def without_near_duplicates(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """The rows of ``docs``, with all their columns, less all but one document of each group.

    The document with the smallest doc_id stays, once if its doc_id is repeated; so do all
    rows with a null doc_id and all documents without words.
    """
    judged = near_duplicates(docs, scheme)
    gone = _small_ids(judged.filter(~F.col("kept")).select("doc_id").distinct(), "near-gone")[0]
    repeated, n = _small_ids(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "near-repeated")
    left = docs.join(gone, "doc_id", "left_anti")
    if n:
        again = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        left = left.join(repeated, "doc_id", "left_anti").unionByName(again)
    return left.select(*[left[c] for c in docs.columns])


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose two-word shingle sets are similar to 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), TWO_WORDS)


OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 2 THEN [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]
         ELSE w END) AS s FROM words),
items AS (SELECT doc_id, unnest(s) AS g FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM items x JOIN items y ON x.g = y.g AND x.doc_id < y.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 80 * (p.n + q.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a)
SELECT reach.a AS doc_id, any_value(n)::BIGINT AS n_shingles, min(reach.b) AS component_id,
       reach.a = min(reach.b) AS kept
FROM reach JOIN sizes ON sizes.doc_id = reach.a GROUP BY reach.a
"""
