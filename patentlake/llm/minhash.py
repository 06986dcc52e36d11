"""MinHash near-duplicates by tensored banding.

Two collections of `side` smaller hashes are computed, each of `rows` minima. Every pair
of one from either collection is the key of a table: side * side tables from
2 * side * rows minima, where independent tables would take side * side * 2 * rows. Sets
of similarity s share a table unless all of one collection differ, at most
2 * (1 - s^rows)^side: about 1e-5 at the threshold with the defaults (0.8, 12 hashes), and
5e-6 at 0.85 with 10. That is the only place where a link can be lost.

Equal sets are one class first. Members of a table's group are never all compared with
each other:

1. In `side` of the tables each member is verified against its group's centre: the member
   that shares these tables with most others, so in a group of copies the text they come
   from. That links most of a large group, and the links become components.
2. Only groups of the tables that still hold several components can add anything. There
   each member is verified against the group's centre if that is in another component.
3. What then lies in different components of groups with one centre is joined by prefixes
   of differences. The symmetric difference of two sets is that of their differences to
   the centre, so sets of sizes m and n, at distances d and e from it, are linked only if
   these differences share (d + e - (m + n) (1 - t) / (1 + t)) / 2 shingles. That is
   more than none where one of the sets isn't linked with the centre. Differences are
   ordered by rarity; a shared shingle counts if its positions leave enough after them.
   First each member meets only the one closest to the centre among those that share a
   shingle with it; what is still apart then meets all of them.
   Copies with changes of their own thus hardly ever meet, and no candidate that could
   be linked is lost.

Before texts are fetched, pairs must pass two exact bounds: that of their sizes, and that of
their shingles counted by ranges of the hash (two sets share at most the smaller count of
each range). What is left is verified on the full shingle sets. Links become components in
the cluster.

A third of all rows may be in one group: the texts of its centre are copied for every
MEMBERS of them, and what else is joined by a group's key is joined with a written table,
so that Spark can split the hot side at run time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patentlake.llm._io import bounded, discard, written
from patentlake.llm._text import LOWER, SPACED_WORD, mix, shingle_hashes, text_slices, word_hashes, words
from patentlake.llm.components import components

SHINGLE = 5
PERCENT = 80
SIDE = 12
ROWS = 2
MEMBERS = 4096  # of one centre that a task compares with one copy of its text


def shingle_sets(data: np.ndarray, offs: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one after another, and their offsets."""
    low = LOWER[data]
    start, end, rows = words(low, offs, SPACED_WORD)
    wh = word_hashes(low, start, end)
    n = len(rows) - 1
    count = np.diff(rows)
    row = np.repeat(np.arange(n), count)
    full = shingle_hashes(wh, shingle)
    inner = row[: len(full)] == row[shingle - 1 :][: len(full)] if len(full) else np.zeros(0, dtype=bool)
    hashes, owner = [full[inner]], [row[: len(full)][inner]]
    for k in range(1, shingle):  # fewer words: the whole sequence is the one shingle
        some = np.flatnonzero(count == k)
        if len(some):
            hashes.append(shingle_hashes(wh, k)[rows[:-1][some]])
            owner.append(some)
    h, o = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return h[new], np.searchsorted(o[new], np.arange(n + 1))


def _factors(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def minima(sets: np.ndarray, offs: np.ndarray, n: int) -> np.ndarray:
    """n minima of each non-empty set (32 bits each); zeros for empty ones."""
    out = np.zeros((len(offs) - 1, n), dtype=np.int32)
    some = np.flatnonzero(np.diff(offs) > 0)
    if len(some):
        for k, f in enumerate(_factors(n)):
            mixed = sets * f
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            least = np.minimum.reduceat(mixed, offs[:-1][some])
            out[some, k] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def range_counts(sets: np.ndarray, offs: np.ndarray) -> list[bytes]:
    """How many shingles of each set lie in each of 2^k equal ranges of the hash, four to eight of them on average; 16 bits each."""
    out = []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        k = max(b - a, 4).bit_length() - 3
        place = np.zeros(b - a, dtype=np.int64) if not k else (sets[a:b] >> np.uint64(64 - k)).astype(np.int64)
        out.append(np.bincount(place, minlength=1 << k).astype("<u2").tobytes())
    return out


def signatures(docs: DataFrame, side: int = SIDE, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """id, key, n (set size), h1 and h2 (together the set's identity), sig (minima) and counts (by hash range) of docs (id, key, text)."""
    n_minima = 2 * side * rows

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i, j, data, offs in text_slices(batch.column("text")):
                sets, at = shingle_sets(data, offs, shingle)
                sums = [np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(sets ^ np.uint64(salt)))]) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                h1, h2 = ((s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums)
                sig = minima(sets, at, n_minima)
                sigs = pa.ListArray.from_arrays(pa.array(np.arange(0, len(sig) * n_minima + 1, n_minima, dtype=np.int32)), pa.array(sig.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id")[i:j], batch.column("key")[i:j], pa.array(np.diff(at).astype(np.int64)), pa.array(h1), pa.array(h2), sigs, pa.array(range_counts(sets, at), pa.binary())], names=["id", "key", "n", "h1", "h2", "sig", "counts"])

    return docs.select("id", "key", "text").mapInArrow(run, "id long, key long, n long, h1 long, h2 long, sig array<int>, counts binary")


def table_keys(sig: np.ndarray, side: int, rows: int, every: bool = True) -> np.ndarray:
    """Keys of the side * side tables for each row of minima: each combines one hash of either collection. Only those of equal places if not `every`."""
    minima_ = sig.astype(np.uint64).reshape(len(sig), 2, side, rows)
    hashes = np.full(minima_.shape[:3], rows, dtype=np.uint64)
    for k in range(rows):
        hashes = mix(hashes ^ minima_[..., k])
    first, second = hashes[:, 0], hashes[:, 1]
    if every:
        first, second = np.repeat(first, side, axis=1), np.tile(second, side)
    number = np.arange(side * side, dtype=np.uint64) if every else np.arange(side, dtype=np.uint64) * np.uint64(side + 1)
    return mix(mix(first ^ number) + second).view(np.int64)


def in_tables(sets: DataFrame, side: int, rows: int, every: bool = True) -> DataFrame:
    """Rows with `table`, the key of each of their tables, in place of `sig`."""
    names = [c for c in sets.columns if c != "sig"]

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                keys = table_keys(part.column("sig").flatten().to_numpy().reshape(part.num_rows, -1), side, rows, every)
                row = pa.array(np.repeat(np.arange(part.num_rows), keys.shape[1]))
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(row) for c in names), pa.array(keys.ravel())], names=[*names, "table"])

    kinds = "".join(f"{c} {sets.schema[c].dataType.simpleString()}, " for c in names)
    return sets.select(*names, "sig").mapInArrow(run, f"{kinds}table long")


def _same_ranges(column: pa.Array, rows: np.ndarray, width: int, narrow: int) -> np.ndarray:
    """Counts of rows that have `width` ranges, as `narrow` ranges."""
    raw = b"".join(column.take(pa.array(rows)).to_pylist())
    return np.frombuffer(raw, dtype="<u2").astype(np.int64).reshape(len(rows), narrow, width // narrow).sum(axis=2)


def _may_link(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose counts by hash range leave room for a link; columns na, nb, ca and cb go."""
    names = [c for c in pairs.columns if c not in ("na", "nb", "ca", "cb")]

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            ca, cb = batch.column("ca"), batch.column("cb")
            wa, wb = (pc.binary_length(c).to_numpy() // 2 for c in (ca, cb))
            both = np.zeros(batch.num_rows, dtype=np.int64)
            for a, b in set(zip(wa.tolist(), wb.tolist(), strict=True)):
                rows = np.flatnonzero((wa == a) & (wb == b))
                for own in np.array_split(rows, max(1, len(rows) * max(a, b) >> 19)):
                    both[own] = np.minimum(_same_ranges(ca, own, a, min(a, b)), _same_ranges(cb, own, b, min(a, b))).sum(axis=1)
            yield batch.select(names).filter(pa.array(100 * both >= percent * (na + nb - both)))

    kinds = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in names)
    return pairs.select(*names, "na", "nb", "ca", "cb").mapInArrow(run, kinds)


def _texts_of(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (a, b, where each is found: ida, keya, idb, keyb, and how many may meet a: size) with the texts ta and tb.

    Rows of one a come together; those of an a with many b are dealt by parts, each with a copy of ta.
    """
    of = {x: texts.select(F.col("id").alias(f"id{x}"), F.col("key").alias(f"key{x}"), F.col("text").alias(f"t{x}")) for x in "ab"}
    parts = (1 + F.floor(F.col("size") / MEMBERS)).cast("long")
    dealt = pairs.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("b"), "parts"))
    left = dealt.select("a", "ida", "keya", "parts", "part").distinct().join(of["a"], ["ida", "keya"]).select("a", "parts", "part", "ta")
    right = dealt.select("a", "parts", "part", "b", "idb", "keyb").join(of["b"], ["idb", "keyb"]).select("a", "parts", "part", "b", "tb")
    return right.join(left, ["a", "parts", "part"]).select("a", "b", "ta", "tb")


def _sets_of(batch: pa.RecordBatch, shingle: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row, set of ta and set of tb of each row; a set of ta serves all rows of its a that follow each other."""
    ids, left = batch.column("a").to_numpy(zero_copy_only=False), batch.column("ta")
    kept, a_set = None, None
    for i, j, data, offs in text_slices(batch.column("tb")):
        sets, at = shingle_sets(data, offs, shingle)
        for r in range(i, j):
            if kept != ids[r]:
                (_, _, d, o), *_ = text_slices(left[r : r + 1])
                kept, a_set = ids[r], shingle_sets(d, o, shingle)[0]
            yield r, a_set, sets[at[r - i] : at[r - i + 1]]


def _verify(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """Exact size of the intersection and union of pairs (a, b) of representatives, on their full sets."""

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            both, union = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
            for r, a_set, b_set in _sets_of(batch, shingle):
                both[r] = n = int(np.isin(b_set, a_set, assume_unique=True).sum())
                union[r] = len(a_set) + len(b_set) - n
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both), pa.array(union)], names=["a", "b", "both", "union"])

    return _texts_of(pairs, texts).mapInArrow(run, "a long, b long, both long, union long")


def _against_centre(members: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """Shingles (token) that only one of member (node) and centre (c) has; n is the set's size, d how many these are."""

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            cs, nodes = (batch.column(c).to_numpy(zero_copy_only=False) for c in "ab")
            for r, c_set, own_set in _sets_of(batch, shingle):
                token = np.setxor1d(own_set, c_set, assume_unique=True).view(np.int64)
                d = len(token)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(d, x, dtype=np.int64)) for x in (cs[r], nodes[r], len(own_set), d)] + [pa.array(token)], names=["c", "node", "n", "d", "token"])

    return _texts_of(members, texts).mapInArrow(run, "c long, node long, n long, d long, token long")


def _prefixes(members: DataFrame, located: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Prefixes of members (c, node, size, component, main): their rarest differences to c, and the position (at) of each."""
    pairs = members.select(F.col("c").alias("a"), F.col("node").alias("b"), "size")
    for x in "ab":
        pairs = pairs.join(located.select(F.col("node").alias(x), F.col("id").alias(f"id{x}"), F.col("key").alias(f"key{x}")), x)
    tokens = written(_against_centre(pairs, texts, shingle), "tokens")
    often = tokens.groupBy("c", "token").agg(F.count("*").alias("often"))
    # a rank, not a number: rows that are there twice don't count twice
    first = F.dense_rank().over(Window.partitionBy("c", "node").orderBy("often", "token")) - 1
    ranked = tokens.join(often, ["c", "token"]).withColumn("at", first.cast("long"))
    prefix = ranked.where((percent * F.col("at") <= (100 - percent) * F.col("n")) & (F.col("often") > 1))  # the most that any partner can leave
    prefix = written(prefix.join(members, ["c", "node"]).select("c", "token", "node", "n", "d", "at", "component", "main").distinct(), "prefixes")
    discard(tokens)
    return prefix


def _enough(percent: int) -> Column:
    """Whether sides a and b can have enough differences in common from the positions ata and atb on."""
    rest = F.least(F.col("da") - F.col("ata"), F.col("db") - F.col("atb"))
    return (100 - percent) * (F.col("na") + F.col("nb")) >= (100 + percent) * (F.col("da") + F.col("db") - 2 * rest)


def _side(prefix: DataFrame, x: str) -> DataFrame:
    return prefix.select("c", "token", *(F.col(k).alias(f"{k}{x}") for k in ("node", "n", "d", "at", "component")), F.col("main").alias(f"main{x}"))


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b")).distinct().withColumn("size", F.lit(0).cast("long"))


def _head_pairs(prefix: DataFrame, percent: int) -> DataFrame:
    """Each member of a shared token with the one of them that is closest to the centre, if in another component."""
    heads = prefix.groupBy("c", "token").agg(F.min(F.struct("d", "node", "n", "at", "component")).alias("h"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    heads = written(heads.select("c", "token", *(F.col(f"h.{k}").alias(f"{k}a") for k in ("node", "n", "d", "at", "component"))), "heads")
    return _pairs(heads.join(_side(prefix, "b"), ["c", "token"]).where(_enough(percent) & (F.col("componenta") != F.col("componentb"))))


def _prefix_pairs(prefix: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of one centre that can be linked and are in different components; two in the centre's component are in one."""
    apart = (F.col("componentb") == F.col("mainb")) | (F.col("componenta") < F.col("componentb"))
    return _pairs(_side(prefix.where("component <> main"), "a").join(_side(prefix, "b"), ["c", "token"]).where(_enough(percent) & apart))


def links(reps: DataFrame, texts: DataFrame, percent: int, side: int, rows: int, shingle: int) -> DataFrame:
    """Links (u, v) between reps (node, id and key of its text, n, sig, counts) that give the components of all candidate pairs that meet the threshold."""
    located = reps.select("node", "id", "key")
    done: list[DataFrame] = []  # written tables that are read for the last time by the next one
    side_of = {x: reps.select(*(F.col(c).alias(f"{short}{x}") for c, short in (("node", ""), ("id", "id"), ("key", "key"), ("n", "n"), ("counts", "c")))) for x in "ab"}
    sizes_fit = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")

    def verified(asked: DataFrame, name: str) -> DataFrame:
        """Links among pairs (a, b, size)."""
        pairs = _may_link(asked.join(side_of["a"], "a").join(side_of["b"], "b").where(sizes_fit), percent)
        both = _verify(pairs, texts, shingle).where(100 * F.col("both") >= percent * F.col("union"))
        return written(both.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), name)

    def against_centres(members: DataFrame, name: str) -> DataFrame:
        return verified(members.groupBy(F.col("c").alias("a"), F.col("node").alias("b")).agg(F.max("size").alias("size")), name)

    def in_components(keyed: DataFrame, found: DataFrame) -> DataFrame:
        return keyed.join(components(found), "node", "left").withColumn("component", F.coalesce("component", "node"))

    def mixed(keyed: DataFrame, name: str) -> DataFrame:
        """Members of groups with several components, with the group's size, its centre c and the centre's component main."""
        groups = keyed.groupBy("table").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size")).where("lo < hi")
        groups = written(groups.select("table", "size"), f"{name}_groups")
        members = written(keyed.join(groups, "table"), name)
        centres = members.groupBy("table").agg(F.max(F.struct("shared", "node", "component")).alias("at"))
        centres = written(centres.select("table", F.col("at.node").alias("c"), F.col("at.component").alias("main")), f"{name}_centres")
        discard(groups)
        done.extend((members, centres))
        return members.join(centres, "table")

    few = in_tables(reps.select("node", "sig"), side, rows, every=False)
    sizes = written(few.groupBy("table").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    few_ = written(few.join(sizes, "table"), "tables")
    shared = few_.groupBy("node").agg(F.sum("size").alias("shared"))
    few = few_.join(shared, "node")
    centres = written(few.groupBy("table").agg(F.max(F.struct("shared", "node")).alias("at")).select("table", F.col("at.node").alias("c")), "centres")
    found = against_centres(few.join(centres, "table").where("node <> c"), "links1")
    each = in_components(reps.join(shared, "node", "left").select("node", "sig", F.coalesce("shared", F.lit(0)).alias("shared")), found)
    members = mixed(in_tables(each.select("node", "component", "shared", "sig"), side, rows), "mixed")
    discard(few_, sizes, centres)
    found = found.unionByName(against_centres(members.where("component <> main"), "links2"))
    members = mixed(in_components(members.select("table", "node", "shared"), found), "mixed_still")
    members = written(members.groupBy("c", "node", "component", "main").agg(F.max("size").alias("size")), "apart")
    discard(*done)
    prefix = prefixes = _prefixes(members, located, texts, percent, shingle)
    heads = verified(_head_pairs(prefix, percent), "links3")
    component_of = members.select("node", "component").distinct()
    between = heads
    for x in "uv":
        between = between.join(component_of.select(F.col("node").alias(x), F.col("component").alias(f"component_{x}")), x)
    now = components(between.select(F.col("component_u").alias("u"), F.col("component_v").alias("v")))
    for x in ("component", "main"):
        prefix = prefix.join(now.select(F.col("node").alias(x), F.col("component").alias("now")), x, "left").withColumn(x, F.coalesce("now", x)).drop("now")
    mixed_tokens = prefix.groupBy("c", "token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("c", "token")
    apart = written(prefix.join(mixed_tokens, ["c", "token"]), "prefixes_apart")
    discard(prefixes)
    return found.unionByName(heads).unionByName(verified(_prefix_pairs(apart, percent), "links4"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, side: int = SIDE, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """Every row of docs with n_shingles, component_id and kept; its text is kept.

    Texts that are null, empty or without words have no shingles and are linked with
    nothing: component_id is their own id. Rows of equal id are documents of their own
    where their texts differ; equal rows get equal results. Rows with a null id are in no
    component (0 shingles, null component_id, kept). Empty docs give an empty table; columns
    named like a result are replaced, others pass through, whatever their names.
    """
    results = ("n_shingles", "component_id", "kept")
    keep = [c for c in docs.columns if c not in results]
    names = [f"k{i}" for i in range(len(keep))]
    id_, said = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string")
    # a text is found by its id and hash; those without an id are spread by the hash
    source = bounded(docs).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], id_.alias("id"), F.xxhash64(said).alias("key"), said.alias("text"))
    plain = source.where("id is not null").select("id", "key", "text")
    found = written(signatures(plain, side, rows, shingle), "signatures").where("n > 0")
    least = F.min(F.struct("id", "key")).alias("least")
    reps = found.groupBy("n", "h1", "h2").agg(least, F.first("sig").alias("sig"), F.first("counts").alias("counts")).select("n", "h1", "h2", "least.id", "least.key", "sig", "counts")
    # a class is named by its least id; only where one id has several texts that are least, others need a name of their own
    other = F.row_number().over(Window.partitionBy("id").orderBy("n", "h1", "h2")) > 1
    reps = written(reps.withColumn("node", F.when(other, F.xxhash64("id", "key", "n", "h1", "h2")).otherwise(F.col("id"))), "representatives")
    classes = written(components(links(reps, plain, percent, side, rows, shingle)).join(reps.select("node", "id"), "node"), "classes")
    least_of = written(classes.groupBy("component").agg(F.min("id").alias("least")), "least")
    of_rep = reps.select("node", "id", "n", "h1", "h2").join(classes.join(least_of, "component").select("node", "least"), "node", "left")
    of_set = of_rep.select("n", "h1", "h2", F.coalesce("least", "id").alias("component"))
    of_row = found.select("id", "key", "n", "h1", "h2").distinct().join(of_set, ["n", "h1", "h2"]).select(F.col("id").alias("of_id"), F.col("key").alias("of_key"), "n", "component")
    out = source.drop("text").join(of_row, (F.coalesce("id", F.lit(0)) == F.col("of_id")) & (F.col("key") == F.col("of_key")) & F.col("id").isNotNull(), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], F.coalesce("n", F.lit(0)).alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
