"""Near-duplicate documents by n-gram Jaccard, found by T-occurrence search.

Two sets are alike when 100 * |A and B| >= percent * |A or B|.  A set of q n-grams needs T of
them in any set it is alike to, so a search reads the inverted lists of its n-grams and keeps
the sets on at least T of them.  DivideSkip does that with the L longest lists set apart: the
short ones are merged, sets on T - L of them are kept, and only these are probed for in the
long lists by binary search.

Which sets are searched in which index is decided without loss.  Equal sets are one set.
Alike sets differ in at most D n-grams, so of D + 1 + E parts that hashing deals n-grams into,
E + 1 at least are equal in both, and one of them is not empty if a set has E empty parts at
most: sets meet under the digests of their full parts.  Sizes fall into classes that fix D and
E; a set also takes part in the class above when a partner may be in it.  A set with more than
E empty parts is dealt out anew under another hash (the last time empty parts count, too).

Digests travel in buckets, as 32 bits each besides the bucket's number, and those that many sets
share once for each batch of texts.  Different digests that fall together only make sets meet that need not.

Where sets meet, each is first searched for among its groups' smallest ids: in the first
round in the block of the one it shares most parts with, then of the next.  What is linked then needs no more comparing among itself: only members outside their group's first
component are indexed, and the whole group is searched in them: a set is asked for only where one
of another component is indexed, of a size it may be alike to, in enough parts.  Indexes and queries are
split by their number of n-grams, so a group of any size is many bounded tasks, and these run in
slices that move about as many n-grams as there are in all: shuffle files don't outgrow the table of sets.
"""

from __future__ import annotations

import hashlib
import heapq
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import WordCache, few, focus, held, release, staged, staged_by
from lakekit.llm.components import connected

PERCENT, WORDS = 90, 3
WORD_CACHE = 200_000
CLASS_RATIO = 1.5           # largest to smallest size in a class
DEALS = 4                   # times a set with too many empty parts is dealt out
BUCKET_SETS = 2000          # sets whose digests fill one bucket, on average
NEED_ROUNDS = 2             # times sets that share too few digests are left out
NEED_WORTH = 0.9            # share of the meets that is left when another such round isn't worth its shuffles
LEAD_ROUNDS = 2             # leads that each set is sent to before whole groups are searched
BLOCK_GRAMS = 200_000       # n-grams in an index, or in the queries sent to it, on average
SLICE_GRAMS = 32_000_000    # n-grams that a search moves at a time at least (where all sets have more: as many)
TABLE_GRAMS = 1_000_000     # n-grams in a bucket of the table of sets, on average
TABLE_MEETS = 500_000       # rows in a bucket of the table of meets, on average
TABLE_BUCKETS = 100_000     # buckets that Spark allows a table unless told otherwise
PROBE_COST = 0.5            # cost of a probe's step against a merged posting
HEAP_POSTINGS = 200         # up to here lists are merged by a heap, beyond by counting

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)     # fixed values of the splitmix64 finalizer
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


@held
def _word_hashes() -> WordCache:
    return WordCache(xxhash.xxh3_64_intdigest, WORD_CACHE)


def gram_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a whole text, A-Z lower-cased; a text of
    fewer words is one n-gram, one without words has none."""
    found = (text or "").encode().lower().split()       # bytes: ASCII white space and case only
    if not found:
        return np.zeros(0, np.int64)
    cache = _word_hashes()
    h = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
    size = min(words, len(h))
    mixed = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        mixed = _mix(mixed * _STEPS[3] + h[k: len(h) - size + 1 + k] + _STEPS[0])
    return np.unique(mixed.view(np.int64))


def size_classes(largest: int, percent: int) -> list[int]:
    """Upper sizes of the classes, from the largest size at which only equal sets are alike."""
    top = max(1, math.ceil((100 + percent) / (2 * (100 - percent))) - 1) if percent < 100 else largest
    out = [top]
    while out[-1] < largest:
        out.append(max(out[-1] + 1, int(out[-1] * CLASS_RATIO)))
    return out


def difference(size: int, percent: int) -> int:
    """Most n-grams in just one of two alike sets of at most this size."""
    return 2 * size * (100 - percent) // (100 + percent)


def spare_parts(most: int, percent: int) -> int:
    """E: about 1.5 times the empty parts to expect in a class's smallest sets."""
    return math.ceil(3 * most * math.exp(-(100 + percent) / (3 * (100 - percent)))) if percent < 100 else 0


def part_digests(grams: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """Digests under which the set meets all sets it may be alike to (none for the smallest
    sets, which are alike to equal ones only), and how many of them it shares with each of
    these at least: of the E + 1 equal parts, its own empty ones say nothing."""
    n = len(grams)
    classes = size_classes(max(1, n * 100 // percent), percent)
    own = int(np.searchsorted(classes, n))
    out, need = [], None
    for c in range(max(1, own), len(classes)):
        most = difference(classes[c], percent)
        spare = spare_parts(most, percent)
        parts = most + 1 + spare
        for deal in range(DEALS):
            salt = np.array([deal + 1, 1 + c * DEALS + deal], np.uint64) * _STEPS[[1, 3]]
            at = (_mix(grams.view(np.uint64) + salt[0]) >> np.uint64(33)) % np.uint64(parts)
            sums = np.zeros(parts, np.uint64)
            np.add.at(sums, at, _mix(grams.view(np.uint64) ^ _STEPS[2]))
            full = np.bincount(at.astype(np.int64), minlength=parts) > 0
            digest = _mix(sums * _STEPS[4] + np.arange(parts, dtype=np.uint64) * _STEPS[0] + salt[1])
            out.append(digest if deal == DEALS - 1 else digest[full])
            empty = np.count_nonzero(~full)
            if deal == 0:
                need = min(need or parts, max(1, spare + 1 - empty))
            if empty <= spare:
                break
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64), need or 1


# ---------------------------------------------------------------- T-occurrence

class InvertedIndex:
    def __init__(self, ids: np.ndarray, sets: list[np.ndarray]):
        self.ids, self.sizes = ids, np.array([len(s) for s in sets], np.int64)
        grams = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.lexsort((owner, grams))
        self.owner = owner[order]
        self.grams, self.first = np.unique(grams[order], return_index=True)
        self.stop = np.append(self.first[1:], len(grams))
        # list number and owner in one sorted key, for binary probes of any list
        self.keys = np.repeat(np.arange(len(self.grams)), self.stop - self.first) * len(sets) + self.owner

    def _merge(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sets on the lists and how many of the lists each is on."""
        lengths = self.stop[lists] - self.first[lists]
        total = int(lengths.sum())
        if total <= HEAP_POSTINGS:
            owners, counts = [], []
            for owner in heapq.merge(*(self.owner[a:b].tolist() for a, b in zip(self.first[lists], self.stop[lists]))):
                if owners and owners[-1] == owner:
                    counts[-1] += 1
                else:
                    owners.append(owner)
                    counts.append(1)
            return np.array(owners, np.int64), np.array(counts, np.int64)
        at = np.repeat(self.first[lists] - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(total)
        counts = np.bincount(self.owner[at], minlength=len(self.sizes))
        owners = np.flatnonzero(counts)
        return owners, counts[owners]

    def search(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Positions of all indexed sets alike to the query."""
        q = len(query)
        least = -(-percent * q // 100)                                          # size of the smallest set alike
        need = -(-percent * (q + least) // (100 + percent))                     # T
        at = np.minimum(np.searchsorted(self.grams, query), len(self.grams) - 1)
        lists = at[self.grams[at] == query]
        if len(lists) < need:
            return np.zeros(0, np.int64)
        lists = lists[np.argsort(self.stop[lists] - self.first[lists], kind="stable")]
        longest = int(self.stop[lists[-1]] - self.first[lists[-1]])
        apart = min(need - 1, int(need / (PROBE_COST * math.log2(longest + 1) + 1)))    # L
        short, long = lists[: len(lists) - apart], lists[len(lists) - apart:]
        owners, counts = self._merge(short)
        keep = counts >= need - apart
        keep &= (self.sizes[owners] >= least) & (self.sizes[owners] * percent <= q * 100)
        found = []
        for owner, count in zip(owners[keep], counts[keep]):
            probe = long * len(self.sizes) + owner
            place = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
            shared = count + np.count_nonzero(self.keys[place] == probe)
            if 100 * shared >= percent * (q + self.sizes[owner] - shared):
                found.append(owner)
        return np.array(found, np.int64)


# ---------------------------------------------------------------- Spark

def _bucketed(digests: list[np.ndarray], owners: list[int], buckets: int) -> tuple[list[tuple], tuple]:
    """([(bucket, tags, ids)], (parts, ids, leads)) of a batch.

    A digest goes on as a part: its bucket and 32 more bits, its tag.  A part that several sets of
    the batch share goes on under the smallest id only, its lead; the members are in the second
    tuple.  So a digest that very many sets share goes on once for each batch.
    """
    digest = np.concatenate([*digests, np.zeros(0, np.int64)]).view(np.uint64)
    part = ((digest % np.uint64(buckets) << np.uint64(32)) | (_mix(digest) >> np.uint64(32))).view(np.int64)
    owner = np.repeat(np.array(owners, np.int64), [len(d) for d in digests])
    order = np.lexsort((owner, part))
    part, owner = part[order], owner[order]
    first = np.append(True, part[1:] != part[:-1])[: len(part)]
    run = np.cumsum(first) - 1
    lead, many = owner[first][run], (np.bincount(run, minlength=1) > 1)[run]
    here = part[many], owner[many], lead[many]
    part, owner = part[first], owner[first]
    bucket, tag = part >> 32, part.astype(np.uint32).view(np.int32)
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    stops = np.append(starts[1:], len(bucket))
    return [(int(bucket[i]), tag[i:j], owner[i:j]) for i, j in zip(starts, stops)], here


SETS = "_id long, n long, need long, print binary, bucket long, tags array<int>, parts array<long>, ids array<long>, leads array<long>"
SET_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 3]
HERE = -1       # bucket of what sets of one batch share


def _sets(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, rows: int) -> DataFrame:
    """A row for each document (_id, n, need: digests it shares with sets alike, print: digest of its set, NULL without one or without
    an id; bucket is NULL) and rows that hold many digests each (bucket, tags or parts, ids; leads)."""
    buckets = max(1, rows // BUCKET_SETS)

    def run(batches):
        focus(_word_hashes)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, digests, owners, seen = [], [], [], set()
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = gram_set(text, words)
                mark = hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) and key is not None else None
                need = None
                if mark is not None and mark not in seen:       # equal sets are linked by their marks
                    seen.add(mark)
                    parts, need = part_digests(grams, percent)
                    digests.append(parts)
                    owners.append(key)
                rows.append((key, len(grams), need, mark, None, None, None, None, None))
            dealt, here = _bucketed(digests, owners, buckets)
            rows += [(None, None, None, None, bucket, tag, None, owner, None) for bucket, tag, owner in dealt]
            if len(here[0]):
                rows.append((None, None, None, None, HERE, None, *here))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), SET_TYPES)], names=[f.split()[0] for f in SETS.split(", ")])
        focus()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, SETS)


def _meets(sets: DataFrame) -> DataFrame:
    """part, id, lead of all sets that share a part with another one."""
    def shared(group: pa.Table) -> pa.Table:
        flat = lambda c: np.concatenate([np.asarray(x.values) for x in group[c]])
        part, owner = (group["bucket"][0].as_py() << 32) + flat("tags").view(np.uint32).astype(np.int64), flat("ids")
        order = np.lexsort((owner, part))
        part, owner = part[order], owner[order]
        first = np.append(True, part[1:] != part[:-1])
        run = np.cumsum(first) - 1
        lead = owner[first][run]
        apart = np.zeros(run[-1] + 1, bool)
        apart[run[owner != lead]] = True
        keep = apart[run]
        return pa.table({"part": pa.array(part[keep]), "id": pa.array(owner[keep]), "lead": pa.array(lead[keep])})

    dealt = sets.where(F.col("bucket") != HERE).select("bucket", "tags", "ids")
    here = sets.where(F.col("bucket") == HERE).select(F.explode(F.arrays_zip("parts", "ids", "leads")).alias("m"))
    return (dealt.groupBy("bucket").applyInArrow(shared, "part long, id long, lead long")
            .union(here.select("m.parts", "m.ids", "m.leads")))


def _buckets(total: int, each: int) -> int:
    return min(max(1, math.ceil(total / each)), TABLE_BUCKETS)


def _grams(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, words: int, total: int) -> DataFrame:
    """id, n, grams of the documents wanted that have words, written in buckets of their ids (``total``: their
    n-grams): texts, which are joined before they are cut up, move once, and the n-grams not at all until a search."""
    def run(batches):
        focus(_word_hashes)
        for batch in batches:
            rows = [(i, s) for i, s in zip(batch.column(0).to_pylist(), (gram_set(t, words) for t in batch.column(1).to_pylist())) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([len(s) for _, s in rows], pa.int64()),
                                              pa.array([s for _, s in rows], pa.list_(pa.int64()))], names=["id", "n", "grams"])
        focus()

    # (with fewer, Spark may deal the join out to its shuffle partitions, each of which then writes a file for each bucket)
    buckets = max(_buckets(total, TABLE_GRAMS), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_text")).where("id is not null")
    texts = texts.repartition(buckets, "id").join(ids, "id")      # (Spark would move a semi join below, and all texts twice)
    return staged_by(texts.mapInArrow(run, "id long, n long, grams array<long>"), "jaccard-grams", "id", buckets)


def _search(index: DataFrame, queries: DataFrame, sets: DataFrame, sizes: DataFrame, percent: int, rows: int, total: int) -> DataFrame:
    """Links a, b that join the queries and indexed sets of each block (columns block, id) as
    all their alike pairs do: each set of a task is linked with the smallest it can reach there.

    A block's index and its queries are each split by their n-grams; every part of one meets
    every part of the other, in a task that holds one part of each.  ``sizes``: id, n of the
    ``sets``, one row an id (rows that share an id are sets of their own).
    ``rows``: how many the index or the queries have at most, roughly.  ``total``: n-grams of all
    ``sets``; the tasks run in slices that move about so many at a time, however often sets are sent.
    """
    def split(side: DataFrame, name: str) -> DataFrame:
        side = side.distinct().join(sizes.select("id", "n"), "id")
        share = side.groupBy("block").agg(F.ceil(F.sum("n") / BLOCK_GRAMS).cast("int").alias(f"{name}_parts"))
        return staged(few(side.select("block", "id", "n").join(share, "block").withColumn(name, F.pmod(F.xxhash64("id"), F.col(f"{name}_parts")).cast("int")), rows), f"search-{name}")

    sides = i, q = split(index, "i"), split(queries, "q")
    i_parts, q_parts = (d.select("block", c).distinct() for d, c in ((i, "i_parts"), (q, "q_parts")))
    i, q = i.join(q_parts, "block"), q.join(i_parts, "block")
    sent = i.select((F.col("n") * F.col("q_parts")).alias("n")).union(q.select(F.col("n") * F.col("i_parts"))).agg(F.sum("n")).first()[0] or 0
    slices = max(1, math.ceil(sent / max(total, SLICE_GRAMS)))
    i = i.select("block", "i", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("q"), "id")
    q = q.select("block", F.explode(F.sequence(F.lit(0), F.col("i_parts") - 1)).alias("i"), "q", "id")

    def find(indexed: pa.Table, asked: pa.Table) -> pa.Table:
        low: dict[int, int] = {}

        def lowest(x: int) -> int:
            while low.setdefault(x, x) != x:
                low[x] = low[low[x]]
                x = low[x]
            return x

        if indexed.num_rows and asked.num_rows:
            arrays = lambda t: [np.asarray(x.values) for x in t["grams"]]
            index = InvertedIndex(indexed["id"].to_numpy(), arrays(indexed))
            for key, grams in zip(asked["id"].to_pylist(), arrays(asked)):
                for other in index.ids[index.search(grams, percent)].tolist():
                    x, y = lowest(key), lowest(other)
                    low[max(x, y)] = min(x, y)
        links = [(x, lowest(x)) for x in low if lowest(x) != x]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    keys = ["block", "i", "q"]
    links = None
    for k in range(slices):
        now = F.pmod(F.xxhash64(*keys), F.lit(slices)) == k
        i_now, q_now = (d.where(now).join(sets.select("id", "grams"), "id").select(*(F.col(c).alias(c) for c in (*keys, "id", "grams"))) for d in (i, q))     # a column of its own on each side
        found = staged(i_now.groupBy(*keys).cogroup(q_now.groupBy(*keys)).applyInArrow(find, "a long, b long"), "jaccard-links")
        links = found if links is None else links.union(found)
    release(*sides)
    return links


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """id, n_shingles, component_id of every row.

    A text without words has no set and is its own component (also where its id has another text), as is a row with a NULL id
    (component NULL).  Rows that share an id are one document: they share its component.
    Repeated rows stay; an empty table gives no rows; other columns are left out.

    Components are what is returned, not the links or their number: a task keeps one spanning
    link for each set, and sets already in one component are not compared.
    """
    count = docs.count()
    sets_and_parts = staged(_sets(docs, id_col, text_col, words, percent, count), "jaccard-sets")
    rows = staged(sets_and_parts.where("bucket is null").select("_id", "n", "need", "print"), "jaccard-rows")
    known = rows.where(F.col("print").isNotNull())
    same = staged(few(known.groupBy("print").agg(F.min("_id").alias("id"), F.count("*").alias("copies")), count), "jaccard-distinct")
    copied = staged(few(same.where("copies > 1").select("print", F.col("id").alias("first")), count), "jaccard-copied")
    meets = staged(_meets(sets_and_parts), "jaccard-meets")
    release(sets_and_parts)
    # a set alike to another shares a number of digests with it: fewer in all, and it is out
    needs = staged(few(known.groupBy(F.col("_id").alias("id")).agg(F.min("need").alias("need")).where("need is not null"), count), "jaccard-needs")
    met = meets.count()
    for _ in range(NEED_ROUNDS):
        buckets = _buckets(met, TABLE_MEETS)
        # (a lead's rows count more than once, so this keeps too many rather than too few)
        enough = meets.groupBy("id").agg(F.count("*").alias("shared")).join(needs, "id").where("shared >= need").select("id")
        left = meets.join(enough, "id", "left_semi").select("part", "id").repartition(buckets, "part")
        leads = left.groupBy("part").agg(F.min("id").alias("lead"), F.max("id").alias("last")).where("lead <> last").select("part", "lead")
        fewer = staged_by(few(left.join(leads, "part"), met, buckets), "jaccard-meets", "part", buckets)
        release(meets)
        before, meets, met = met, fewer, fewer.count()
        if met > NEED_WORTH * before:
            break
    # equal sets, and rows that share an id but not a text
    links = known.join(copied, "print").where("_id <> first").select(F.col("_id").alias("a"), F.col("first").alias("b")).distinct()
    done, found_links = [meets, needs], 0
    if not meets.isEmpty():
        wanted = staged(few(meets.select("id").distinct(), count), "jaccard-wanted")
        total = rows.withColumnRenamed("_id", "id").join(wanted, "id", "left_semi").agg(F.sum("n")).first()[0]
        sets = _grams(docs, wanted, id_col, text_col, words, total)
        pairs = staged(few(meets.where("id <> lead").groupBy("id", "lead").agg(F.count("*").alias("parts")), met), "jaccard-pairs")
        sizes = staged(few(sets.groupBy("id").agg(F.sum("n").alias("n"), F.min("n").alias("low"), F.max("n").alias("high")), count), "jaccard-sizes")
        blocks = max(1, math.ceil(total / BLOCK_GRAMS))
        block = F.pmod(F.xxhash64("lead"), F.lit(blocks)).alias("block")
        best = F.max(F.struct("parts", (-F.col("lead")).alias("lead")))["lead"]
        first, so_far, left_pairs = None, None, pairs
        for _ in range(LEAD_ROUNDS):
            chosen = staged(few(left_pairs.groupBy("id").agg((-best).alias("lead")), count), "jaccard-chosen")
            done.append(chosen)
            if chosen.isEmpty():
                break
            links_now = _search(chosen.select(block, F.col("lead").alias("id")), chosen.select(block, "id"), sets, sizes, percent, count, total)
            first = links_now if first is None else first.union(links_now)
            so_far = connected(first, first.count())
            of_lead = so_far.select(F.col("id").alias("lead"), F.col("component").alias("of_lead"))
            left_pairs = (left_pairs.join(chosen, ["id", "lead"], "left_anti").join(so_far, "id", "left").join(of_lead, "lead", "left")
                          .where(F.coalesce("component", "id") != F.coalesce("of_lead", "lead")).select("id", "lead", "parts"))
        # a part's smallest id is its lead: whoever is outside its component is so in the pairs, of which there are few
        apart = staged(few(pairs.join(so_far, "id", "left").join(of_lead, "lead", "left")
                           .where(F.coalesce("component", "id") != F.coalesce("of_lead", "lead")).select("id", "lead"), met), "jaccard-apart")
        mixed = staged(few(meets.join(apart, ["id", "lead"], "left_semi").select("part").distinct(), met), "jaccard-mixed")
        of_id = (needs.join(sizes, "id").join(so_far, "id", "left").join(apart.groupBy("id").agg(F.collect_set("lead").alias("not_of")), "id", "left")
                 .select("id", "need", "low", "high", F.coalesce("component", "id").alias("component"), "not_of"))
        left = staged(few(meets.join(mixed, "part").join(of_id, "id")
                          .withColumn("outside", F.coalesce(F.array_contains("not_of", F.col("lead")), F.lit(False))).drop("not_of"), met), "jaccard-left")
        if not left.isEmpty():
            # those outside are indexed with others of their smallest group leader
            home = staged(few(left.where("outside").groupBy("id").agg(F.min("lead").alias("block")), count), "jaccard-home")
            goes = (left.where("outside").join(home, "id").groupBy("part", "block")
                    .agg(F.min("component").alias("first"), F.max("component").alias("last"), F.min("low").alias("least"), F.max("high").alias("most"), F.min("need").alias("needs")))
            # alike sets share at least `need` parts here (that of either), and one of the two is outside in half of
            # them: it is found by the other in its home, so fewer parts in a block than that say nothing; nor do
            # parts in which all that are at home there are in one component with who asks, or too large or too small
            # (parts that count twice keep too many rather than too few)
            asked = (left.join(goes, "part").where("component <> first or component <> last").where(f"100 * high >= {percent} * least and {percent} * low <= 100 * most")
                     .groupBy("block", "id").agg(F.count("*").alias("shared"), F.greatest(F.min("need"), F.min("needs")).alias("need"))
                     .where("2 * shared >= need").select("block", "id"))
            first = first.union(_search(home, asked, sets, sizes, percent, left.count(), total))
            done += [home]
        links, found_links = links.union(first), first.count()
        done += [wanted, sets, sizes, pairs, apart, mixed, left]
    found = connected(links, count + found_links)
    release(*done)
    final = same.select("print", "id").join(found, "id", "left").select("print", F.coalesce("component", "id").alias("_component"))
    changed = final.join(same.select("print", "id", "copies"), "print").where("copies > 1 or _component <> id").select("print", "_component")
    return (rows.select("_id", "n", "print").join(staged(few(changed, count), "jaccard-changed"), "print", "left")
            .select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("_component", "_id").alias("component_id")))
