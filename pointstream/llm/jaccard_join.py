"""N-gram Jaccard join by PartEnum signatures.

A document's set is that of its five-word shingles, as 64-bit hashes. Two documents link
when 100 * intersection >= 80 * union, that is, when their sets differ in at most a ninth
of their summed sizes.

1. Equal sets are found by a digest; one document of each such class goes on.
2. Sizes are cut into bands. An instance takes the sets of one band and those that can be
   the smaller partner of one, and bounds the difference of its pairs by ``k``. It cuts
   the domain of hashes into more than ``k`` partitions; a linked pair agrees on the rest
   of them. A set's signatures are its non-empty partitions.
3. Two sets might agree on empty partitions only. There are ``extra`` partitions beyond
   ``k + 1`` for that: a set with at most ``extra`` empty ones agrees with every partner
   on a signature. A set with more is put into another variant of the instance as well,
   with other partitions; its partner either has fewer, or is put there too. After the
   last variant it gets one signature for being empty.
4. What a set has of ``extra`` to spare, a linked partner shares in signatures: of the
   signatures that others hold too, a set leaves out as many as it can spare, the most
   frequent first, in one order for all sets. The rarest signature of a linked pair is
   left out by neither. So sets that have a passage in common, and no more, do not meet.
5. A document is compared with the smallest id among those it meets most often, which
   makes components. Then, in signatures whose documents are not all in one component,
   documents of different components are held against each other by sketches: parities
   of 512 ranges of the hashes, which differ in no more places than the sets do. Only
   pairs whose sketches allow a link come out, and of these only those that also have
   the common signatures a link needs are compared, exactly, on the sets. A pair with many
   common signatures comes out of the first of them: a signature leaves out pairs that have
   an earlier one in common, as far as the few first ones of each set tell. So no group is
   expanded into all pairs, and no link between two components is missed. A signature of
   very many documents is dealt out in chunks, so that tasks stay bounded.

Hot keys are split. A sample tells which signatures are held by very many documents; their
rows are dealt out by document, counted and ranked in two steps. It decides where rows go,
not what comes out. Classes of very many copies are few, and are joined by broadcast.

Documents without words have an empty set and link with nothing; null texts are empty. A
null id gets a null component. Rows that repeat an id are one document, whose links are
those of all its rows. Ties cannot occur: the smallest id names the component. Empty
tables give empty results; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pointstream.llm.components import components
from pointstream.llm.frames import free_name, kept, tidied
from pointstream.llm.words import LOWER_WORDS, Part, constants, mixed, parts

SHINGLE = 5
PERCENT = 80
# Largest size of a band, as a multiple of its smallest.
BAND = 1.5
# Partitions beyond k + 1, as a share of k + 1 and at least.
EXTRA_SHARE = 0.25
EXTRA_LEAST = 2
VARIANTS = 5
# Ranges of a sketch, and documents of a signature that one group of rows holds.
SKETCH_BITS = 512
CHUNK = 2048
# Documents held against all others of their group at a time.
BLOCK = 32
# Signatures of a set that its rows carry, by which a pair comes out of one signature only.
FIRST = 8
_NO_SIGNATURE = (1 << 63) - 1
# Members that one task compares with a hub at a time.
HUB_MEMBERS = 512
# Ids up to which a table is broadcast; a larger one is shuffled.
BROADCAST_IDS = 1_000_000
# A key is hot with so many rows, and so large a share of all that there are few such keys.
HOT_ROWS = 2048
HOT_KEYS = 10_000
# One document in so many is asked which signatures are hot.
HOT_SAMPLE = 64


def _bands() -> list[tuple[int, int]]:
    out, low = [], 1
    while low < 1 << 40:
        high = max(low, int(low * BAND))
        out.append((low, high))
        low = high + 1
    return out


BANDS = _bands()
_LOW = np.array([low for low, _ in BANDS])
_HIGH = np.array([high for _, high in BANDS])


def linked(a: int, b: int, common: int) -> bool:
    """Whether sets of sizes ``a`` and ``b`` with so many common members link."""
    return 100 * common >= PERCENT * (a + b - common)


def _instances(size: int) -> np.ndarray:
    return np.flatnonzero((PERCENT * _LOW <= 100 * size) & (size <= _HIGH))


def _difference(sizes: int) -> int:
    """The most in which two linked sets of these summed sizes differ."""
    return sizes * (100 - PERCENT) // (100 + PERCENT)


def _geometry(band: int) -> tuple[int, int]:
    """Number of partitions and ``extra`` of an instance."""
    k = _difference(2 * int(_HIGH[band]))
    if k == 0:
        return 1, 0
    extra = EXTRA_LEAST + int(EXTRA_SHARE * (k + 1))
    return k + 1 + extra, extra


def shingle_sets(part: Part) -> list[np.ndarray]:
    """Sorted shingle hashes of each text of a part."""
    found = part.tokens(LOWER_WORDS)
    counts = np.diff(found.first)
    sets = [np.zeros(0, dtype=np.uint64)] * len(part)
    at, h = found.windows(SHINGLE)
    cut = np.searchsorted(at, found.first)
    for r in np.flatnonzero(counts >= SHINGLE):
        sets[r] = np.unique(h[cut[r] : cut[r + 1]])
    for size in range(1, SHINGLE):
        short = np.flatnonzero(counts == size)
        if len(short):
            at, h = found.windows(size, seed=SHINGLE + size)
            where = np.searchsorted(at, found.first[short])
            for r, w in zip(short, where):
                sets[r] = h[w : w + 1]
    return sets


def _digest(s: np.ndarray) -> tuple[int, int]:
    halves = mixed(s), mixed(s ^ np.uint64(0x5851F42D4C957F2D))
    return tuple(int(x.sum(dtype=np.uint64).astype(np.int64)) for x in halves)


def sketch(s: np.ndarray) -> bytes:
    """Parity of the number of hashes in each of ``SKETCH_BITS`` ranges."""
    shift = np.uint64(64 - (SKETCH_BITS - 1).bit_length())
    counts = np.bincount((s >> shift).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits(counts & 1).tobytes()


def signatures(s: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """Instance, spare ``extra`` (below 0 if short of it) and signatures of a set, by instance."""
    out = []
    for band in _instances(len(s)):
        count, extra = _geometry(band)
        for variant in range(VARIANTS):
            members = s
            if variant:
                members = np.sort(mixed(s ^ constants(VARIANTS, 11)[variant]))
            partition = ((members >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
            begin = np.flatnonzero(np.diff(partition, prepend=partition[:1] + np.uint64(1)))
            instance = int(band) * VARIANTS + variant
            place = partition[begin] + np.uint64(instance << 40)
            found = mixed(np.add.reduceat(members, begin) + mixed(place))
            spare = extra - (count - len(begin))
            if spare < 0 and variant == VARIANTS - 1:
                empty = mixed(np.array([(instance << 40) + (1 << 39)], dtype=np.uint64))
                found = np.append(found, empty)
            out.append((instance, spare, found))
            if spare >= 0:
                break
    return out


def _id_rows(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("bigint").alias("doc"), F.col(text).alias("text"))


def _facts(rows: DataFrame) -> DataFrame:
    """Size, digest and sketch of every document's set."""

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, one, two, marks = [], [], [], []
            for part in parts(batch.column("text")):
                for s in shingle_sets(part):
                    digest = _digest(s)
                    size.append(len(s))
                    one.append(digest[0])
                    two.append(digest[1])
                    marks.append(sketch(s))
            made = [pa.array(x, pa.int64()) for x in (size, one, two)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *made, pa.array(marks, pa.binary())],
                names=["doc", "n_shingles", "d1", "d2", "sketch"],
            )

    made = "n_shingles bigint, d1 bigint, d2 bigint, sketch binary"
    return rows.mapInArrow(tidied(facts), f"doc bigint, {made}")


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to a table of one row a key. Hot keys, of which there are few, go by broadcast."""
    counts = left.groupBy(*keys).count()
    total = left.count()
    hot = counts.filter(F.col("count") >= max(HOT_ROWS, total / HOT_KEYS)).select(*keys)
    hot = kept(left.sparkSession, hot.join(right, keys), "hot-keys")
    cold = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(right, keys, "left")
    return cold.unionByName(left.join(F.broadcast(hot), keys))


def _copies(facts: DataFrame) -> DataFrame:
    """Documents whose rows all have one set, that of a smaller id, and the smallest such id."""
    filled = facts.filter("n_shingles > 0 AND doc IS NOT NULL").select("doc", "d1", "d2")
    classes = filled.groupBy("d1", "d2").agg(F.min("doc").alias("rep"), F.max("doc").alias("other"))
    several = classes.filter("rep != other").drop("other")
    joined = _joined(filled, several, ["d1", "d2"]).select("doc", F.coalesce("rep", "doc").alias("rep"))
    by_id = joined.groupBy("doc").agg(F.min("rep").alias("rep"), F.max("rep").alias("last"))
    return by_id.filter("rep = last AND rep != doc").select("doc", "rep")


def _only_if_small(frame: DataFrame, ids: str = "1") -> DataFrame:
    """Marked for broadcast if its rows, of ``ids`` ids each, hold at most ``BROADCAST_IDS``."""
    held = frame.agg(F.sum(F.expr(ids))).first()[0] or 0
    return F.broadcast(frame) if held <= BROADCAST_IDS else frame


# A tag holds the instance, the spare ``extra`` (moved to be above 0) and the size of a set.
_SPARE_AT, _INSTANCE_AT = 31, 52
_ZERO_SPARE = 1 << (_INSTANCE_AT - _SPARE_AT - 1)


def _signature_rows(rows: DataFrame) -> DataFrame:
    """(sig, doc, tag) of all sets."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch.column("text")):
                ids = batch.column("doc").slice(part.row, len(part)).to_pylist()
                docs, tags, found = [], [], []
                for doc, s in zip(ids, shingle_sets(part)):
                    for instance, spare, each in signatures(s) if len(s) else ():
                        docs.append(doc)
                        above = min(spare + _ZERO_SPARE, 2 * _ZERO_SPARE - 1)
                        tags.append(instance << _INSTANCE_AT | above << _SPARE_AT | len(s))
                        found.append(each.astype(np.int64))
                ends = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
                flat = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, pa.int64()),
                        pa.array(tags, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    names=["doc", "tag", "sigs"],
                )

    made = rows.mapInArrow(tidied(sign), "doc bigint, tag bigint, sigs array<bigint>")
    return made.select(F.explode("sigs").alias("sig"), "doc", "tag")


def _most(instance: str) -> str:
    """SQL: ``k`` of an instance."""
    each = ", ".join(str(_difference(2 * high)) for _, high in BANDS)
    return f"array({each})[CAST({instance} div {VARIANTS} AS INT)]"


def _tag_columns() -> list:
    above = F.shiftright("tag", _SPARE_AT).bitwiseAND(F.lit(2 * _ZERO_SPARE - 1))
    return [
        F.shiftright("tag", _INSTANCE_AT).cast("int").alias("instance"),
        F.col("tag").bitwiseAND(F.lit((1 << _SPARE_AT) - 1)).alias("size"),
        (above - _ZERO_SPARE).alias("spare"),
    ]


def _short(instance: str, size: str, other: str) -> str:
    """SQL: what the sizes of a pair take off its allowed difference in the instance."""
    return f"({_most(instance)} - ({size} + {other}) * {100 - PERCENT} div {100 + PERCENT})"


def _hot_signatures(rows: DataFrame) -> DataFrame:
    """Signatures that a sample holds very often, and the ``salts`` to deal each to.

    At most ``HOT_KEYS`` signatures, of as many salts in all and one more each.
    """
    sampled = rows.filter(F.pmod(F.xxhash64("doc"), F.lit(HOT_SAMPLE)) == 0)
    counts = _signature_rows(sampled).groupBy("sig").count()
    counts = kept(rows.sparkSession, counts, "signature-sample")
    total = counts.agg(F.sum("count")).first()[0] or 0
    most = max(HOT_ROWS / HOT_SAMPLE, total / HOT_KEYS)
    hot = counts.filter(F.col("count") >= most)
    return hot.select("sig", F.ceil(F.col("count") / most).cast("int").alias("salts"))


def _several(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Signatures of two or more documents, with their number: key, sig, hot, doc, tag, held.

    Rows are counted by ``key``: the signature, or one of a hot signature's salts. One
    column sorts faster than two. Hot signatures are counted by partial aggregation; should
    a salt's hash meet another signature, that counts as more frequent for all its sets.
    """
    spark = rows.sparkSession
    salt = F.pmod(F.xxhash64("doc", "tag"), F.col("salts"))
    key = F.when(F.col("salts").isNull(), F.col("sig")).otherwise(F.xxhash64("sig", salt))
    salted = rows.join(F.broadcast(hot), "sig", "left").select(
        key.alias("key"), F.when(F.col("salts").isNotNull(), F.col("sig")).alias("hot"), "doc", "tag"
    )
    held = F.count("*").over(Window.partitionBy("key"))
    several = salted.withColumn("held", held).filter("held > 1 OR hot IS NOT NULL")
    several = kept(spark, several, "signatures")
    all_held = several.filter("hot IS NOT NULL").groupBy("hot").agg(F.count("*").alias("all_held"))
    all_held = kept(spark, all_held, "hot-signatures")
    whole = several.join(F.broadcast(all_held), "hot", "left")
    sig, held = F.coalesce("hot", "key").alias("sig"), F.coalesce("all_held", "held").alias("held")
    return whole.select("key", sig, "hot", "doc", "tag", held).filter("held > 1")


def _meetings(several: DataFrame) -> DataFrame:
    """Signatures without those that a set can spare; of two or more documents still.

    ``rank`` is the document's place among those of its signature, ``hub`` the signature's smallest
    document and ``many`` the number of its documents.
    """
    highs = ", ".join(f"{high}L" for _, high in BANDS)
    largest = f"least(array({highs})[CAST(instance div {VARIANTS} AS INT)], size * 100 div {PERCENT})"
    of_set = Window.partitionBy("doc", "tag").orderBy(F.desc("held"), "sig")
    once = several.repartition("doc", "tag").dropDuplicates(["doc", "tag", "sig"])
    rare = (
        once.withColumn("place", F.row_number().over(of_set))
        .select("key", "sig", "hot", "doc", "place", *_tag_columns())
        .filter(F.expr(f"place > spare + {_short('instance', 'size', largest)}"))
    )
    same = Window.partitionBy("key").orderBy("doc")
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = rare.select(
        "key",
        "hot",
        "doc",
        "instance",
        F.row_number().over(same).alias("rank"),
        F.first("doc").over(whole).alias("hub"),
        F.count("*").over(whole).alias("many"),
    )
    spark = several.sparkSession
    ranked = kept(spark, ranked.filter("many > 1 OR hot IS NOT NULL"), "meetings")
    # A hot signature's ranks go on from salt to salt.
    salts = ranked.filter("hot IS NOT NULL").groupBy("hot", "key").agg(
        F.min("doc").alias("low"), F.count("*").alias("n")
    )
    of_sig = Window.partitionBy("hot")
    earlier = of_sig.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    salts = salts.select(
        "hot",
        "key",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.min("low").over(of_sig).alias("all_hub"),
        F.sum("n").over(of_sig).alias("all_many"),
    )
    salts = kept(spark, salts, "hot-meetings")
    return (
        ranked.join(F.broadcast(salts), ["hot", "key"], "left")
        .select(
            F.coalesce("hot", "key").alias("sig"),
            "doc",
            "instance",
            (F.col("rank") + F.coalesce("before", F.lit(0))).alias("rank"),
            F.coalesce("all_hub", "hub").alias("hub"),
            F.coalesce("all_many", "many").alias("many"),
        )
        .filter("many > 1")
    )


def _signature_lists(several: DataFrame, meetings: DataFrame) -> DataFrame:
    """All signatures of each set that meets others, with what it can spare: doc, instance."""
    lists = several.groupBy("doc", "tag").agg(F.collect_set("sig").alias("sigs"))
    met = meetings.select("doc", "instance").distinct()
    rows = lists.select("doc", "sigs", *_tag_columns()).join(met, ["doc", "instance"], "left_semi")
    return kept(several.sparkSession, rows, "signature-lists")


def _enough(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """Those of the pairs (a, b, instance) that have the common signatures a link needs."""
    one, two = (
        lists.select(
            F.col("doc").alias(name), "instance", *(F.col(c).alias(f"{c}_{name}") for c in ("sigs", "size", "spare"))
        )
        for name in ("a", "b")
    )
    sizes = f"{PERCENT} * size_a <= 100 * size_b AND {PERCENT} * size_b <= 100 * size_a"
    need = f"greatest(spare_a, spare_b) + {_short('instance', 'size_a', 'size_b')}"
    both = pairs.join(one, ["a", "instance"]).join(two, ["b", "instance"])
    enough = both.filter(f"{sizes} AND size(array_intersect(sigs_a, sigs_b)) > {need}")
    return enough.select("a", "b").distinct()


def _hub_pairs(meetings: DataFrame) -> DataFrame:
    """For each document, the smallest document of its signatures that it meets most often."""
    met = meetings.filter("doc != hub").groupBy("doc", "hub", "instance").count()
    most = F.max(F.struct("count", (-F.col("hub")).alias("hub"), "instance")).alias("best")
    nearest = met.groupBy("doc").agg(most)
    return nearest.select((-F.col("best.hub")).alias("a"), F.col("doc").alias("b"), "best.instance")


def _verified(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that link, compared on their sets.

    Every document's set is made once and sent to the groups of pairs it is in. The
    pairs of one ``a`` are dealt out to groups of about ``HUB_MEMBERS``; a task holds
    one set of ``a`` at a time.
    """
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_MEMBERS).cast("int").alias("groups"))
    dealt = pairs.join(groups, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("part")
    )
    hubs = groups.select("a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"))
    wanted = hubs.select(F.col("a").alias("doc"), "a", "part").unionAll(
        dealt.select(F.col("b").alias("doc"), "a", "part")
    )
    by_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("a", "part")).alias("at"))
    by_doc = kept(rows.sparkSession, by_doc, "compared")
    given = rows.join(_only_if_small(by_doc, "size(at)"), "doc")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("at").to_pylist()
            ids = batch.column("doc").to_pylist()
            for part in parts(batch.column("text")):
                out = []
                for r, s in enumerate(shingle_sets(part)):
                    doc, body = ids[part.row + r], s.tobytes()
                    out += [(p["a"], p["part"], doc, body) for p in places[part.row + r]]
                columns = zip(*out) if out else ([], [], [], [])
                types = pa.int64(), pa.int32(), pa.int64(), pa.binary()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["a", "part", "doc", "members"],
                )

    sent = given.mapInArrow(tidied(send), "a bigint, part int, doc bigint, members binary")
    ordered = sent.repartition("a", "part").sortWithinPartitions(
        "a", "part", (F.col("doc") != F.col("a")).cast("int")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, hubs = None, []
        for batch in batches:
            found = set()
            columns = [batch.column(n).to_pylist() for n in ("a", "part", "doc", "members")]
            for a, part, doc, body in zip(*columns):
                members = np.frombuffer(body, dtype=np.uint64)
                if group != (a, part):
                    group, hubs = (a, part), []
                if doc == a:
                    hubs.append(members)
                    continue
                for hub in hubs:
                    if not len(hub) or not len(members):
                        continue
                    near = np.minimum(np.searchsorted(hub, members), len(hub) - 1)
                    common = int((hub[near] == members).sum())
                    if linked(len(hub), len(members), common):
                        found.add((a, doc))
            columns = zip(*found) if found else ([], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["a", "b"]
            )

    return ordered.mapInArrow(tidied(compare), "a bigint, b bigint")


def _open(meetings: DataFrame, found: DataFrame) -> DataFrame:
    """Meetings in signatures whose documents are not all in one component, with it."""
    labels = found.select(F.col("node").alias("doc"), "component")
    labelled = meetings.join(labels, "doc", "left").withColumn(
        "component", F.coalesce("component", "doc")
    )
    labelled = kept(meetings.sparkSession, labelled, "labelled")
    ends = labelled.groupBy("sig").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    rows = labelled.join(ends.filter("low != high").select("sig"), "sig", "left_semi")
    return kept(meetings.sparkSession, rows, "open-signatures")


def _met_before(first: np.ndarray, sig: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Of pairs of rows, those whose first signatures have one before ``sig`` in common."""
    met = np.zeros(len(one), dtype=bool)
    for mine in first[one].T:
        met |= (mine < sig) & (first[two] == mine[:, None]).any(axis=1)
    return met


def _against(group: dict[str, np.ndarray], found: set) -> None:
    """Pairs of a group (of one chunk, or of two) whose sketches allow a link."""
    doc, component, size, chunk = (group[n] for n in ("doc", "component", "size", "chunk"))
    marks, instance = group["sketch"], int(group["instance"][0])
    cut = int(np.searchsorted(chunk, chunk[0], side="right"))
    if component.min() == component.max():
        return
    # Of two chunks, the first against the second; of one, each against those after it.
    for low in range(0, cut if cut < len(doc) else len(doc) - 1, BLOCK):
        high = min(low + BLOCK, cut)
        begin = cut if cut < len(doc) else low + 1
        differ = np.bitwise_count(marks[low:high, None] ^ marks[None, begin:]).sum(axis=2, dtype=np.int64)
        sizes = size[low:high, None] + size[None, begin:]
        near = differ * (100 + PERCENT) <= sizes * (100 - PERCENT)
        near &= component[low:high, None] != component[None, begin:]
        one, two = np.nonzero(near)
        one, two = one + low, two + begin
        later = one < two
        one, two = one[later], two[later]
        if "first" in group:
            new = ~_met_before(group["first"], group["sig"][0], one, two)
            one, two = one[new], two[new]
        for a, b in zip(doc[one].tolist(), doc[two].tolist()):
            found.add((a, b, instance) if a < b else (b, a, instance))


def _candidates(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Pairs (a, b, instance) of different components that meet and may link by their sketches."""
    marks = facts.select("doc", F.col("n_shingles").alias("size"), "sketch").distinct()
    chunks = F.ceil(F.col("many") / CHUNK).cast("int")
    chunk = F.floor((F.col("rank") - 1) / CHUNK).cast("int")
    others = F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other")
    padded = F.concat(F.array_sort(F.collect_set("sig")), F.array_repeat(F.lit(_NO_SIGNATURE), FIRST))
    firsts = rows.groupBy("doc", "instance").agg(F.slice(padded, 1, FIRST).alias("first"))
    dealt = rows.join(firsts, ["doc", "instance"]).join(marks, "doc").select(
        "sig", "doc", "component", "instance", "size", "sketch", "first", chunk.alias("chunk"), others
    )
    dealt = dealt.withColumn("low", F.least("chunk", "other")).withColumn(
        "high", F.greatest("chunk", "other")
    )
    key = ["sig", "low", "high"]
    ordered = dealt.drop("other").repartition(*key).sortWithinPartitions(*key, "chunk")

    def arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        plain = [n for n in batch.schema.names if n not in ("sketch", "first")]
        out = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in plain}
        out["first"] = batch.column("first").flatten().to_numpy().reshape(len(batch), FIRST)
        body = b"".join(batch.column("sketch").to_pylist())
        out["sketch"] = np.frombuffer(body, dtype=np.uint64).reshape(len(batch), -1)
        return out

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last group of a batch may go on in the next
        for batch in _and_none(batches):
            now = arrays(batch) if batch is not None and len(batch) else None
            if batch is not None and now is None:
                continue
            if now is not None and rest is not None:
                now = {n: np.concatenate([rest[n], now[n]]) for n in now}
            elif now is None:
                now = rest
            if now is None:
                return
            keys = np.stack([now[n] for n in key], axis=1)
            ends = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            begins = np.concatenate([[0], ends, [len(keys)]])
            last = len(begins) - 1 if batch is None else len(begins) - 2
            found = set()
            for low, high in zip(begins[:last], begins[1 : last + 1]):
                if high - low > 1:
                    _against({n: v[low:high] for n, v in now.items()}, found)
            rest = {n: v[begins[last] :] for n, v in now.items()} if batch is not None else None
            columns = zip(*found) if found else ([], [], [])
            types = pa.int64(), pa.int64(), pa.int32()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["a", "b", "instance"]
            )

    return ordered.mapInArrow(tidied(hold), "a bigint, b bigint, instance int").distinct()


def _and_none(batches: Iterator) -> Iterator:
    """All batches, and None once they have ended."""
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``."""
    spark = docs.sparkSession
    rows = _id_rows(docs, id_column, text)
    facts = kept(spark, _facts(rows), "shingle-sets")
    copies = kept(spark, _copies(facts), "copies")
    rows = rows.filter("doc IS NOT NULL")
    single = rows.join(_only_if_small(copies.select("doc")), "doc", "left_anti")
    several = _several(_signature_rows(single), _hot_signatures(single))
    meetings = _meetings(several)
    lists = _signature_lists(several, meetings)
    pairs = kept(spark, _enough(_hub_pairs(meetings), lists), "pairs")
    links = kept(spark, _verified(rows, pairs), "verified")
    found = components(links)
    more = _enough(_candidates(_open(meetings, found), facts), lists)
    more = kept(spark, more.join(pairs, ["a", "b"], "left_anti"), "pairs")
    new = kept(spark, _verified(rows, more), "verified")
    if not new.isEmpty():
        found = components(links.unionAll(new))

    labels = found.select(F.col("node").alias("rep"), "component")
    reps = facts.select("doc", "n_shingles").join(copies, "doc", "left")
    reps = reps.withColumn("rep", F.coalesce("rep", "doc"))
    return _joined(reps, labels, ["rep"]).select(
        F.col("doc").alias(id_column),
        "n_shingles",
        F.coalesce("component", "rep").alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those of a group but its smallest id; columns unchanged.

    Rows are documents of their own: those that share an id, or have none, go only where
    their texts are linked. Of a group's rows the one of smallest id stays, one without an
    id only if all are, and of equal ids the first by a hash of the text.
    """
    spark, ids = docs.sparkSession, F.col(f"`{id_column}`").cast("bigint")
    shared = docs.groupBy(ids.alias("id")).agg(F.count("*").alias("n"))
    if shared.filter("id IS NULL OR n > 1").isEmpty():
        # Each id is a row.
        found = kept(spark, near_duplicates(docs, id_column, text), "near-duplicates")
        gone_id = free_name(docs, "_gone")
        gone = found.filter(F.col(id_column) != F.col("component_id")).select(F.col(id_column).alias(gone_id))
        return docs.join(_only_if_small(gone), ids == F.col(gone_id), "left_anti")
    row = free_name(docs, "_row")
    numbered = kept(spark, docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    texts = numbered.select(F.col(row).alias("row"), F.col(f"`{text}`").alias("text"))
    found = kept(spark, near_duplicates(texts, "row", "text"), "near-duplicates")
    order = F.struct(ids.isNull().alias("none"), ids.alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(row).alias("row"))
    places = numbered.select(F.col(row).alias("row"), order.alias("place"))
    least = places.join(found, "row").groupBy("component_id").agg(F.min("place").alias("least"))
    least = kept(spark, least.select(F.col("least.row").alias("_stays")), "stay")
    return numbered.join(least, F.col(row) == F.col("_stays"), "left_semi").drop(row)
