"""MinHash near-dedup: ProbMinHash signatures of weighted word shingles, banding, verification.

Method. A text's shingles are its runs of five words (all its words, if fewer), each with weight
1 + ln(times). Every shingle sends a Poisson process of that rate to the registers of a signature;
the earliest arrival at a register leaves the shingle's mark there, and a shingle stops as soon as
its arrivals come later than the latest register. The share of equal registers of two texts
estimates the probability Jaccard similarity of their weighted shingles (for unit weights it is the
Jaccard similarity). BANDS bands of ROWS registers make candidates; two texts are linked if their
probability Jaccard, or that of the plain sets, is at least THRESHOLD, both computed exactly.

A text in which shingles repeat has a second signature of unit weights, whose bands stand beside the
first ones; of other texts both are the same, so bands of either kind meet.

Classes are the connected components of the links. Equal texts are one node. A bucket is never
expanded into all pairs. Each member is first compared with the LEADERS leaders that it shares most
bands with (a bucket's centre and MASKS random ones), and components are formed. Then rounds follow, as
long as a fair share (PROGRESS) of their comparisons finds a link: in a bucket that still holds several
components, the members outside its largest one are compared with TRIES leaders of other components,
drawn anew each round. What stays apart after that is compared with the other components of its buckets
where REGISTERS registers of either signature allow the similarity at all: MIN_ESTIMATE lies 3.2
standard errors below it, so a pair exactly at the threshold is passed over with probability 7e-4,
and one at 0.85 with 1e-8. A pair at the threshold shares no bucket with probability 7e-5.
Comparisons grow with the texts, but for texts that share buckets with many others and have no link to
them: their signatures must be held against all of these, so none is lost.

Edge cases: null is the empty text; texts without words are alike only if they are equal; null ids
rank last; rows that repeat id and text belong to one class, and one of them is kept.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import Words, batch_of, fresh, mix, text_chunks, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
#: Registers of a signature; the bands take the first ones.
REGISTERS = 256
MIN_ESTIMATE = 0.72
#: Random leaders of a bucket besides its centre, and how many of its buckets' leaders a text is compared with.
MASKS, LEADERS = 1, 2
#: Leaders drawn in a bucket, and compared with a text, in each later round; a round that links less than
#: this share of its pairs is the last one.
HEADS, TRIES, PROGRESS = 4, 8, 0.005
LAST = (1 << 63) - 1


def shingles(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, times) of every text, each shingle once, in order of text and shingle."""
    at, hashes = words.windows(k)
    text = words.text_of[at] if len(at) else at
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    whole = np.zeros(len(short), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k - 1):
            has = words.counts[short] > j
            whole[has] = whole[has] * np.uint64(0x9E3779B97F4A7C15) + words.hashes[words.first[:-1][short[has]] + j]
    text, hashes = np.concatenate((text, short)), np.concatenate((hashes, mix(whole ^ np.uint64(k))))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    begin = np.flatnonzero(new)
    return text[begin], hashes[begin], np.diff(np.append(begin, len(text)))


def weights(times: np.ndarray) -> np.ndarray:
    return 1 + np.log(times)


def signatures(n: int, text: np.ndarray, hashes: np.ndarray, weight: np.ndarray, size: int = REGISTERS) -> np.ndarray:
    """n x size marks. Round k takes the k-th arrival of every shingle that can still come early."""
    earliest = np.full(n * size, np.inf)
    marks = np.zeros(n * size, np.uint32)
    low = (mix(hashes) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    when, k = np.zeros(len(text)), 0
    while len(text):
        with np.errstate(over="ignore"):
            draw = mix(hashes ^ (np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15)))
        when = when - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        at = text * size + (mix(draw) % np.uint64(size)).astype(np.int64)
        np.minimum.at(earliest, at, when)
        first = earliest[at] == when
        marks[at[first]] = low[first]
        latest = earliest.reshape(n, size).max(axis=1)
        on = when < latest[text]
        text, hashes, weight, low, when = text[on], hashes[on], weight[on], low[on], when[on]
        k += 1
    return marks.reshape(n, size)


def band_keys(marks: np.ndarray, rows: int = ROWS) -> np.ndarray:
    parts = marks.reshape(len(marks), marks.shape[1] // rows, rows).astype(np.uint64)
    key = np.zeros(parts.shape[:2], np.uint64)
    with np.errstate(over="ignore"):
        for j in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j] + np.uint64(1))
    return key


def probability_jaccard(x: np.ndarray, y: np.ndarray, sums: tuple[float, float]) -> float:
    """Of the weights x and y of the shared shingles; sums: all weights of either side, so that
    shingles of one side count as pairs with a zero."""
    if not len(x):
        return 0.0
    order = np.argsort(x / y)
    x, y = x[order], y[order]
    ratio = x / y
    rest_x = sums[0] - x.sum()  # shingles of x alone lie above every ratio, of y alone below
    rest_y = sums[1] - y.sum()
    last = np.searchsorted(ratio, ratio, side="right")
    upper = np.append(np.cumsum(x[::-1])[::-1], 0.0)[last] + rest_x  # ratios above
    lower = np.cumsum(y)[last - 1] + rest_y  # up to this ratio
    return float((1 / (upper / x + lower / y)).sum())


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Exact similarity of each pair of texts: the larger of both measures."""
    sides = []
    for side in (left, right):
        words = Words(side)
        text, hashes, times = shingles(words)
        sides.append((hashes, weights(times), np.searchsorted(text, np.arange(len(side) + 1))))
    out = np.zeros(len(left))
    (ha, wa, fa), (hb, wb, fb) = sides
    for i in range(len(out)):
        a, b = slice(fa[i], fa[i + 1]), slice(fb[i], fb[i + 1])
        _, ia, ib = np.intersect1d(ha[a], hb[b], assume_unique=True, return_indices=True)
        n = len(ha[a]) + len(hb[b]) - len(ia)
        if len(ia):
            out[i] = max(len(ia) / n, probability_jaccard(wa[a][ia], wb[b][ib], (float(wa[a].sum()), float(wb[b].sum()))))
    return out


SIGNED = pa.schema([("doc", pa.int64()), ("hash1", pa.int64()), ("hash2", pa.int64()), ("signature", pa.list_(pa.int16())), ("plain", pa.list_(pa.int16())), ("bands", pa.list_(pa.int64()))])


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_chunks(batch, 2 << 20):
            words = Words(part.column(3))
            text, hashes, times = shingles(words)
            own = np.flatnonzero(words.counts > 0)
            place = np.cumsum(words.counts > 0) - 1
            marks = signatures(len(own), place[text], hashes, weights(times))
            # unit weights give other marks only where a shingle repeats
            many = np.unique(place[text[times > 1]])
            inner = np.isin(place[text], many)
            unit = signatures(len(many), np.searchsorted(many, place[text[inner]]), hashes[inner], np.ones(inner.sum()))
            keys = [band_keys(m[:, : BANDS * ROWS]).view(np.int64) for m in (marks, unit)]
            short = lambda m: (m & np.uint32(0xFFFF)).astype(np.uint16).view(np.int16)
            yield batch_of(
                SIGNED, doc=part.column(0), hash1=part.column(1), hash2=part.column(2),
                signature=rows_of(len(part), own, short(marks)), plain=rows_of(len(part), own[many], short(unit)),
                bands=rows_of(len(part), np.concatenate((own, own[many])), np.concatenate(keys)),
            )


def rows_of(n: int, owner: np.ndarray, rows: np.ndarray) -> pa.Array:
    """n lists: the rows of each owner, one after the other."""
    order = np.argsort(owner, kind="stable")
    offsets = np.searchsorted(owner[order], np.arange(n + 1)) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(rows[order].ravel()))


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_chunks(batch, 1 << 20, "left_text"):
            good = pa.array(similarities(part.column(2), part.column(3)) >= threshold)
            yield pa.RecordBatch.from_arrays([part.column(0).filter(good), part.column(1).filter(good)], schema=PAIR)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): the least node that it is joined to.
    Labels spread along the links and then jump to their label's label, so chains halve."""
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = written(both, "links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        reach = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(reach.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("new"))
        spread = written(spread, "labels")
        jumped = spread.join(spread.select(F.col("node").alias("new"), F.col("new").alias("next")), "new").select("node", "old", F.least("new", "next").alias("label"))
        labels = written(jumped, "labels")
        if labels.where("old != label").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.select("node", "label")


class Texts:
    """Texts of the nodes that share a bucket, written once; pairs are verified against them."""

    def __init__(self, texts: DataFrame, threshold: float):
        self.texts, self.threshold = texts, threshold

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose texts are similar enough."""
        left = self.texts.select(F.col("node").alias("a"), F.col("text").alias("left_text"))
        right = self.texts.select(F.col("node").alias("b"), F.col("text").alias("right_text"))
        joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left_text", "right_text")
        return written(joined.mapInArrow(lambda it, t=self.threshold: verify(it, t), "a long, b long"), "links")


def leaders(buckets: DataFrame, masks: int = MASKS, chosen: int = LEADERS) -> DataFrame:
    """(a, b): each node with the leaders that it shares most buckets with. A bucket's leaders are
    its most central node, the one with most companions in all its buckets, and the least of its
    nodes under masks that differ by band."""
    central = buckets.groupBy("node").agg((F.sum("n") * F.lit(1 << 20) + F.pmod(F.xxhash64("node"), F.lit(1 << 20))).alias("weight"))
    mask = [F.xxhash64("band", F.lit(m)) for m in range(masks)]
    head = buckets.join(central, "node").groupBy("band", "key").agg(
        F.max_by("node", "weight").alias("centre"), *[F.min(F.col("node").bitwiseXOR(m)).alias(f"m{i}") for i, m in enumerate(mask)]
    )
    found = F.array_distinct(F.array("centre", *[F.col(f"m{i}").bitwiseXOR(m) for i, m in enumerate(mask)]))
    pairs = buckets.join(head, ["band", "key"]).select(F.col("node").alias("a"), F.explode(found).alias("b")).where("a != b")
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    order = Window.partitionBy("a").orderBy(F.desc("n"), F.xxhash64("a", "b"), "b")
    return counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= chosen).select("a", "b")


def apart(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The buckets' nodes with their components, where a bucket holds more than one component."""
    placed = buckets.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("band", "key")
    return placed.join(mixed, ["band", "key"])


def strays(members: DataFrame) -> DataFrame:
    """The members, and whether they stand outside the largest component of their bucket."""
    sizes = members.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
    top = sizes.groupBy("band", "key").agg(F.max(F.struct("n", "component")).alias("top"))
    return members.join(top, ["band", "key"]).select("band", "key", "node", "component", (F.col("component") != F.col("top.component")).alias("stray"))


def stray_pairs(members: DataFrame, tried: DataFrame, turn: int) -> DataFrame:
    """(a, b): strays with the leaders of other components that they share most buckets with."""
    mask = [F.xxhash64("band", F.lit(turn), F.lit(i)) for i in range(HEADS)]
    drawn = [F.min(F.struct(F.col("node").bitwiseXOR(m).alias("order"), "node", F.col("component").alias("other"))).alias(f"m{i}") for i, m in enumerate(mask)]
    heads = members.groupBy("band", "key").agg(*drawn).select("band", "key", F.array(*[f"m{i}" for i in range(HEADS)]).alias("heads"))
    met = members.where("stray").join(heads, ["band", "key"]).select("node", "component", F.explode(F.array_distinct("heads")).alias("head"))
    met = met.where("component != head.other").groupBy(F.col("node").alias("a"), F.col("head.node").alias("b")).agg(F.count("*").alias("n"))
    met = met.join(tried, ["a", "b"], "left_anti").join(tried.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
    order = Window.partitionBy("a").orderBy(F.desc("n"), F.xxhash64("a", "b"), "b")
    return met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TRIES).select("a", "b")


def open_pairs(members: DataFrame, marks: DataFrame, tried: DataFrame) -> DataFrame:
    """(a, b): strays with members of other components of their buckets, if they may be similar."""
    side = lambda s: members.join(marks, "node").select("band", "key", *[F.col(c).alias(f"{s}_{c}") for c in ("node", "component", "stray", "signature", "plain", "bands")])
    equal = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p == q), F.lit(0), lambda n, p: n + p.cast("int"))
    unit = lambda s: F.when(F.size(f"{s}_plain") > 0, F.col(f"{s}_plain")).otherwise(F.col(f"{s}_signature"))
    least = int(MIN_ESTIMATE * REGISTERS)
    repeats = (F.size("a_plain") > 0) | (F.size("b_plain") > 0)
    near = F.when(equal("a_signature", "b_signature") >= least, True).when(repeats, equal(unit("a"), unit("b")) >= least)
    once = (F.col("a_component") != F.col("b_component")) & (~F.col("b_stray") | (F.col("a_node") < F.col("b_node")))
    # a pair is compared in the first band in which any key of one is a key of the other
    keys = lambda s: (F.slice(f"{s}_bands", 1, BANDS), F.slice(f"{s}_bands", F.size(f"{s}_bands") - BANDS + 1, BANDS))
    meets = [F.zip_with(x, y, lambda p, q: p == q) for x in keys("a") for y in keys("b")]
    any_of = F.zip_with(F.zip_with(meets[0], meets[1], lambda p, q: p | q), F.zip_with(meets[2], meets[3], lambda p, q: p | q), lambda p, q: p | q)
    first = F.array_position(F.when(repeats, any_of).otherwise(meets[0]), True) == F.col("band") + 1
    found = side("a").where("a_stray").join(side("b"), ["band", "key"]).where(F.when(once, F.when(first, near)))
    return found.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components of the nodes after more links: components of components."""
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    alone = ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("component"))
    known = written(labels.union(alone), "labels")
    of = lambda c: known.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in"))
    edges = links.join(of("a"), "a").join(of("b"), "b").where("a_in != b_in").select(F.col("a_in").alias("a"), F.col("b_in").alias("b"))
    moved = components(edges).select(F.col("node").alias("component"), F.col("component").alias("now"))
    return written(known.join(moved, "component", "left").select("node", F.coalesce("now", "component").alias("component")), "labels")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row per document: doc_id, class_id (the least id of its class), class_size, keep (one
    document of each class), and the hashes of its text."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(text).alias("hash1"),
        F.xxhash64(F.lit("second"), text).alias("hash2"),
        text.alias("text"),
    )
    signed = keyed.mapInArrow(sign, "doc long, hash1 long, hash2 long, signature array<short>, plain array<short>, bands array<long>")
    signed = written(signed.withColumn("row", F.monotonically_increasing_id()), "signatures")
    same = signed.groupBy("hash1", "hash2").agg(F.min("row").alias("node"))
    every = signed.join(same.select(F.col("node").alias("row")), "row").select(F.col("row").alias("node"), F.posexplode("bands").alias("band", "key"))
    every = written(every.withColumn("band", F.col("band") % BANDS), "bands")
    shared = every.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = written(every.join(shared, ["band", "key"]), "buckets")
    wanted = signed.join(buckets.select(F.col("node").alias("row")).distinct(), "row")
    wanted = written(wanted.withColumnRenamed("row", "node"), "marks")
    found = keyed.join(wanted.select("node", "doc", "hash1", "hash2"), ["doc", "hash1", "hash2"]).select("node", "text").dropDuplicates(["node"])
    texts = Texts(written(found, "texts"), threshold)
    tried = written(leaders(buckets), "pairs")
    labels = components(texts.links(tried))
    turn, share = 0, 1.0
    while share >= PROGRESS:
        members = written(strays(apart(buckets, labels)), "apart")
        pairs = written(stray_pairs(members, tried, turn), "pairs")
        more = texts.links(pairs)
        compared, linked = pairs.count(), more.count()
        tried, turn, share = tried.union(pairs), turn + 1, linked / max(compared, 1)
        if linked:
            labels = merged(labels, more)
    rest = strays(apart(buckets, labels))
    more = texts.links(open_pairs(rest, wanted.select("node", "signature", "plain", "bands"), tried))
    if not more.isEmpty():
        labels = merged(labels, more)
    member = signed.select("row", "doc", "hash1", "hash2").join(same.select("hash1", "hash2", "node"), ["hash1", "hash2"])
    member = member.join(labels, "node", "left").select("row", "doc", "hash1", "hash2", F.coalesce("component", "node").alias("component"))
    member = written(member, "members")
    classes = member.groupBy("component").agg(F.min("doc").alias("least"), F.count("*").alias("class_size"))
    heads = member.join(classes.select("component", "least"), "component").where("doc = least").groupBy("component").agg(F.min("row").alias("head"))
    out = member.join(classes, "component").join(heads, "component")
    known = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return out.select(known("doc").alias("doc_id"), known("least").alias("class_id"), "class_size", (F.col("row") == F.col("head")).alias("keep"), "hash1", "hash2")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with all their columns, one of each class: the least id, and of rows that
    repeat it with the same text, one."""
    found = near_duplicates(docs, id_column, text_column, threshold)
    names = [fresh(f"_near_{k}", docs.columns) for k in range(4)]
    heads = found.where("keep").select(F.coalesce("doc_id", F.lit(LAST)).alias(names[0]), F.col("hash1").alias(names[1]), F.col("hash2").alias(names[2]))
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.withColumns(
        {names[0]: F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)), names[1]: F.xxhash64(text), names[2]: F.xxhash64(F.lit("second"), text)}
    )
    kept = keyed.join(heads, names[:3], "left_semi")
    once = kept.withColumn(names[3], F.row_number().over(Window.partitionBy(*names[:3]).orderBy(F.lit(1))))
    return once.where(F.col(names[3]) == 1).select(*[f"`{c}`" for c in docs.columns])
