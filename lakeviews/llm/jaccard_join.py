"""N-gram Jaccard join by chosen paths.

Texts are sets of five-word shingles; equal sets are one class of copies.
Each class has a signature of minimum hash values (shared tokens sampled alike
by all sets).  A run puts every class into the node of one sampled token.  A
node of up to ``LEAF`` classes is compared by brute force; a larger one is
split on ``BRANCH`` further sampled tokens, and so on.  A node that splitting
does not part (most of its members share the next token too, so they are near
copies of each other) or that is still large at ``DEPTH`` is compared by brute
force in pairs of blocks, so nothing is cut off.  Runs repeat until a pair at
the threshold is met with probability ``RECALL``.

Every meeting place of a class travels with it, and a pair counts only in the
first place both share, so links are counted exactly without listing pairs.
Places then give a star of links per local component; minimum labels with
pointer jumping join these to classes.

Defined results: words are runs of anything but ASCII white space; a text of
one to four words is one shingle of all its words; null and wordless texts and
rows without an id are linked with nothing (class_id is their own id);
repeated rows are copies of each other; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from lakeviews.llm import bytewords as bw
from lakeviews.llm.common import save, table

WORDS = 5
SIMILAR = Fraction(4, 5)
RECALL = 0.9999
LEAF = 256
BLOCK = 1_000
BRANCH = 2
DEPTH = 4
SPLITS = 24  # signature values to split on, besides one for each run


def runs(similar: float = float(SIMILAR), recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold has met, split at every depth on the way, with probability ``recall``."""
    met = 1.0
    for _ in range(DEPTH - 1):
        met = 1 - (1 - similar * met) ** BRANCH
    return math.ceil(math.log(1 - recall) / math.log(1 - similar * met))


SIGNATURE = runs() + SPLITS
_FACTORS = np.random.RandomState(5).randint(1, 1 << 62, SIGNATURE).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of whole texts, in order of both."""
    w = bw.words(raw, offs)
    row, h = bw.grams(w, WORDS)
    count = np.diff(w.first)
    for n in range(1, WORDS):  # shorter texts: all words
        few = np.flatnonzero(count == n)
        if len(few):
            at = w.first[few]
            own = np.full(len(few), np.uint64(n))
            for k in range(n):
                own = bw.mixed(own * np.uint64(0x9E3779B97F4A7C15) + w.hash[at + k])
            row, h = np.concatenate([row, few]), np.concatenate([h, own])
    return bw.distinct(row, h)


def _set_ids(row: np.ndarray, h: np.ndarray, n: int) -> tuple[list[bytes | None], np.ndarray]:
    """(id of each row's set, None if empty; index of each row's first shingle and one more)."""
    cut = np.searchsorted(row, np.arange(n + 1))
    upto = [np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)]) for x in (bw.mixed(h + np.uint64(77)), bw.mixed(h ^ np.uint64(0xABCDEF123457)))]
    parts = [bw.mixed(u[cut[1:]] - u[cut[:-1]] + np.diff(cut).astype(np.uint64)) for u in upto]
    both = np.stack(parts, 1).astype("<u8").tobytes()
    return [both[16 * i:16 * i + 16] if cut[i + 1] > cut[i] else None for i in range(n)], cut


def identified(docs: DataFrame, signed: bool, doc_id: str = "doc_id", text: str = "text", name: str = "set_id") -> DataFrame:
    """The documents with ``name``, the id of their shingle set; ``signed``: and ``name``_signature."""

    def of(batches):
        for b in batches:
            has_id = pc.is_valid(b.column(doc_id)).to_numpy(zero_copy_only=False)
            for lo, hi, raw, offs in bw.chunks(b.column(text)):
                row, h = shingles(raw, offs)
                ids, cut = _set_ids(row, h, hi - lo)
                part = b.slice(lo, hi - lo)
                ids = [x if ok else None for x, ok in zip(ids, has_id[lo:hi])]
                more = [pa.array(ids, pa.binary())]
                if signed:
                    sign = np.zeros((hi - lo, SIGNATURE), np.uint64)
                    full = np.flatnonzero(np.diff(cut))
                    for k in range(SIGNATURE if len(full) else 0):
                        sign[full, k] = np.minimum.reduceat(h * _FACTORS[k], cut[full])
                    more.append(pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * SIGNATURE, pa.int32()), pa.array(sign.ravel().view(np.int64))))
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*b.schema.names, name, f"{name}_signature"][:b.num_columns + 1 + signed])

    extra = [StructField(name, BinaryType())] + ([StructField(f"{name}_signature", ArrayType(LongType()))] if signed else [])
    return docs.mapInArrow(of, StructType([*docs.schema.fields, *extra]))


def _coordinates() -> list[Column]:
    """The places in the signature, from 0 and all different, that a node is split on.

    They follow from the node alone, so that all its members use the same.
    """
    step = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(SPLITS // BRANCH)) + 1
    return [F.pmod(F.pmod(F.xxhash64("node", F.lit(0)), F.lit(SPLITS)) + step * k, F.lit(SPLITS)) + runs() for k in range(BRANCH)]


def _places(reps: DataFrame) -> DataFrame:
    """(set_id, place, blocks): where classes meet, places of two or more with different members."""
    start = F.explode(F.array(*[F.struct(F.lit(r).alias("run"), F.xxhash64(F.lit(r), F.element_at("signature", r + 1)).alias("node")) for r in range(runs())]))
    nodes = reps.select("set_id", start.alias("s")).select("set_id", "s.run", "s.node")
    children = F.array(*[F.xxhash64("node", F.lit(k), F.element_at("signature", (at + 1).cast("int"))) for k, at in enumerate(_coordinates())])
    found = []
    for depth in range(1, DEPTH + 1):
        nodes = save(nodes, f"jaccard-nodes{depth}")
        mark = F.xxhash64("set_id")
        sizes = save(nodes.groupBy("run", "node").agg(F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(mark, 20)).alias("members"), F.bit_xor(mark).alias("mixed"))
                     .filter("n > 1"), f"jaccard-sizes{depth}")
        small = sizes.filter(F.col("n") <= LEAF).groupBy("n", "members", "mixed").agg(F.min(F.struct("run", "node")).alias("at")).select("at.run", "at.node", F.lit(1).alias("blocks"))
        large = sizes.filter(F.col("n") > LEAF)
        blocks = F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
        if large.isEmpty():
            chosen, split = small, None
        elif depth == DEPTH:
            chosen, split = small.unionByName(large.select("run", "node", blocks)), None
        else:
            # Only members of large nodes are joined with their signatures.
            inside = save(nodes.join(large.select("run", "node", "n"), ["run", "node"]).join(reps.select("set_id", "signature"), "set_id")
                          .select("set_id", "run", "node", "n", children.alias("children")), f"jaccard-split{depth}")
            kin = (inside.groupBy("run", "node", "n", F.element_at("children", 1)).count()
                   .groupBy("run", "node", "n").agg((F.max("count") * 2 > F.col("n")).alias("dense")))
            kin = save(kin, f"jaccard-large{depth}")
            chosen = small.unionByName(kin.filter("dense").select("run", "node", blocks))
            split = (inside.join(kin.filter("NOT dense").select("run", "node"), ["run", "node"], "left_semi")
                     .select("set_id", "run", F.explode("children").alias("node")))
        # Places are ordered by run first.
        place = F.shiftleft(F.col("run").cast("long"), 56).bitwiseOR(F.shiftrightunsigned("node", 8))
        found.append(nodes.select("set_id", "run", "node").join(chosen, ["run", "node"]).select("set_id", place.alias("place"), "blocks"))
        if split is None:
            break
        nodes = split
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _similar(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of pairs at or above the threshold."""
    size = np.array([len(s) for s in sets])
    token, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = np.bincount(at) > 1
    number = np.cumsum(shared) - 1
    use = shared[at]
    row, at = row[use], number[at[use]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(at, [lo, lo + 4096])
        block = np.zeros((len(sets), min(4096, int(shared.sum()) - lo)), np.float32)
        block[row[a:b], at[a:b] - lo] = 1
        common += block @ block.T
    both = size[:, None] + size[None, :]
    return common * (SIMILAR.numerator + SIMILAR.denominator) >= SIMILAR.numerator * both


def _met(places: list[np.ndarray], here: int) -> np.ndarray:
    """Matrix of pairs that share an earlier place."""
    earlier = [p[p < here] for p in places]
    if not sum(map(len, earlier)):
        return np.zeros((len(places), len(places)), bool)
    return _incidence(earlier)


def _incidence(lists: list[np.ndarray]) -> np.ndarray:
    _, at = np.unique(np.concatenate(lists), return_inverse=True)
    m = np.zeros((len(lists), at.max() + 1), np.float32)
    m[np.repeat(np.arange(len(lists)), [len(x) for x in lists]), at] = 1
    return m @ m.T > 0


def _compared(place: int, cross: bool, ids: list[bytes], size: np.ndarray, block: np.ndarray, places: list[np.ndarray], sets: list[np.ndarray]):
    """(set ids, links, least set id of the local component) of the classes with a link that counts here."""
    one = sorted({x: i for i, x in reversed(list(enumerate(ids)))}.values())  # a repeated row's set comes twice
    ids, size, block, places, sets = [ids[i] for i in one], size[one], block[one], [places[i] for i in one], [sets[i] for i in one]
    if len(ids) < 2:
        return [], [], []
    linked = _similar(sets)
    np.fill_diagonal(linked, False)
    if cross:
        linked &= block[:, None] != block[None, :]
    if linked.any():
        linked &= ~_met(places, place)
    links = linked @ size
    rank = np.argsort(np.argsort(np.array(ids, dtype=object)))
    label = rank.copy()
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(ids)).min(1))
        if (low == label).all():
            break
        label = low
    by_rank = sorted(ids)
    has = np.flatnonzero(linked.any(1))
    return [ids[i] for i in has], [int(links[i]) for i in has], [by_rank[label[i]] for i in has]


def _linked(batches):
    """Rows come sorted by (place, p, q); each such group is compared by itself."""
    key, held = None, []

    def done():
        ids, links, root = _compared(key[0], key[1] != key[2], [r[0] for r in held], np.array([r[1] for r in held]), np.array([r[2] for r in held]),
                                     [r[3] for r in held], [r[4] for r in held])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(links, pa.int64()), pa.array(root, pa.binary())], ["set_id", "links", "root"])

    for b in batches:
        keys = zip(*(b.column(c).to_pylist() for c in ("place", "p", "q")))
        ids, size, block = (b.column(c).to_pylist() for c in ("set_id", "copies", "block"))
        places, sets = b.column("places"), b.column("hashes")
        for i, k in enumerate(keys):
            if k != key:
                if len(held) > 1:
                    yield done()
                key, held = k, []
            held.append((ids[i], size[i], block[i], places[i].values.to_numpy(), sets[i].values.to_numpy()))
    if len(held) > 1:
        yield done()


def _hashed(batches):
    """The shingle hashes of each text whose set id is the one looked for."""
    for b in batches:
        for lo, hi, raw, offs in bw.chunks(b.column("text")):
            row, h = shingles(raw, offs)
            ids, cut = _set_ids(row, h, hi - lo)
            part = b.slice(lo, hi - lo)
            hashes = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(h.view(np.int64)))
            own = pa.RecordBatch.from_arrays([part.column("set_id"), part.column("copies"), part.column("places"), part.column("at"), hashes],
                                             ["set_id", "copies", "places", "at", "hashes"])
            yield own.filter(pa.array([x == y for x, y in zip(ids, part.column("set_id").to_pylist())]))


def components(edges: DataFrame) -> DataFrame:
    """(id, label): the least id of each id's component, from links (a, b) in one direction."""
    both = save(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "jaccard-edges")
    labels = save(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "jaccard-labels")
    while True:
        least = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(least, F.col("id") == F.col("a")).select("id", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        lower = save(lower, "jaccard-labels")
        jump = lower.alias("x").join(lower.select(F.col("id").alias("on"), F.col("label").alias("far")).alias("y"), F.col("x.label") == F.col("y.on"))
        new = save(jump.select("x.id", "x.was", F.least("x.label", "y.far").alias("label")), "jaccard-labels")
        labels = new.select("id", "label")
        if new.filter("label != was").isEmpty():
            return labels


def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(set_id, rep, copies, links, label): a row for each class of equal sets.

    rep: its least document id; links: documents of other classes that are
    similar; label: the least set id of its component.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed = save(identified(rows, True).select("doc_id", "set_id", F.col("set_id_signature").alias("signature")).filter("set_id IS NOT NULL"), "jaccard-sets")
    reps = save(signed.groupBy("set_id").agg(F.min(F.struct("doc_id", "signature")).alias("r"), F.count(F.lit(1)).alias("copies"))
                .select("set_id", F.col("r.doc_id").alias("rep"), F.col("r.signature").alias("signature"), "copies"), "jaccard-classes")
    places = _places(reps.select("set_id", "signature"))
    lists = places.groupBy("set_id").agg(F.sort_array(F.collect_set(F.struct("place", "blocks"))).alias("at"))
    need = lists.join(reps.select("set_id", "rep", "copies"), "set_id").select("set_id", "rep", "copies", F.col("at.place").alias("places"), "at")
    sets = (rows.join(need, F.col("doc_id") == F.col("rep")).select("text", "set_id", "copies", "places", "at")
            .mapInArrow(_hashed, "set_id binary, copies long, places array<long>, at array<struct<place: long, blocks: int>>, hashes array<long>"))
    spread = sets.select("set_id", "copies", "places", "hashes", F.explode("at").alias("m"))
    own = F.pmod(F.xxhash64("set_id", "m.place"), F.col("m.blocks")).cast("int")
    spread = (spread.select("set_id", "copies", "places", "hashes", F.col("m.place").alias("place"), F.col("m.blocks").alias("blocks"), own.alias("block"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    spread = spread.select("place", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "set_id", "copies", "places", "hashes")
    met = (spread.repartition("place", "p", "q").sortWithinPartitions("place", "p", "q")
           .mapInArrow(_linked, "set_id binary, links long, root binary"))
    met = save(met, "jaccard-links")
    count = met.groupBy("set_id").agg(F.sum("links").alias("links"))
    label = components(met.filter("set_id != root").select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    out = (reps.select("set_id", "rep", "copies").join(count, "set_id", "left").join(label.withColumnRenamed("id", "set_id"), "set_id", "left"))
    return save(out.select("set_id", "rep", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("label", "set_id").alias("label")), "jaccard-result")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(set_id, class_id, label, n_links): class_id is the least document id of the class's component."""
    found = links(docs, doc_id, text)
    least = found.groupBy("label").agg(F.min("rep").alias("class_id"))
    return found.join(least, "label").select("set_id", "class_id", "label", (F.col("links") + F.col("copies") - 1).alias("n_links"))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links), one row per document; n_links counts other documents that are similar."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    mine = identified(rows, False).select("doc_id", "set_id")
    out = mine.join(classes(docs, doc_id, text), "set_id", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns, without those that are near copies of one with a lower id."""
    name = "set_id"
    while name in docs.columns:
        name = f"_{name}"
    found = classes(docs, doc_id, text).select(F.col("set_id").alias("_own"), F.col("class_id").alias("_class"), F.col("label").alias("_label"))
    mine = identified(docs, False, doc_id, text, name)
    out = mine.join(found, F.col(name) == F.col("_own"), "left")
    alone = out.filter(F.col("_own").isNull())
    first = out.filter(F.col(doc_id) == F.col("_class")).dropDuplicates([doc_id, "_label"])
    return alone.unionByName(first).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
