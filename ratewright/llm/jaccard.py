"""N-gram Jaccard join with token-combination prefixes.

A document's set holds its distinct word shingles as 64-bit hashes. Tokens are put in one global order: rare
ones by hash, then frequent ones by hash. With n tokens and a threshold t, two linked sets share at least
k of the first ``n - ceil(t n) + k`` tokens of either, namely their first k shared ones (the k-prefix). So

* a pair whose first shared token is rare meets under that single token of both 1-prefixes;
* any other pair meets under its first two shared tokens, both frequent, within both 2-prefixes.

Equal sets are one node throughout. Before pairs are formed, every node is verified against one leader, the
most central node of the buckets it shares most; groups linked that way are known to be connected, so only pairs
across groups are left. A group of thousands of near copies thus costs a row or two per copy, and no link
between different groups is missed. Candidates are verified by the size of the true intersection.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.components import components
from ratewright.llm.text import WordHasher, as_bytes, id_type, map_rows, mixed, whole_rows
from ratewright.storage import materialise

SHINGLE = 5
THRESHOLD = 75  # percent
FREQUENT = 16  # a token in more 1-prefixes than this is frequent
COMING_FORWARD = 0.2  # share of frequent tokens in a 1-prefix from which on the rest of the set is counted
MOST_FREQUENT = 1_000_000  # frequent tokens at most; beyond that the bound above is doubled
FILTER_BITS = 23
_NONE = np.empty(0, "uint64")
FIRST_FACTOR = 0x9E3779B97F4A7C15
STEP_FACTOR = 0xC2B2AE3D27D4EB4E


class Shingler:
    """Sorted distinct shingle hashes of texts.

    A shingle's hash is the sum of its word hashes, each times the odd factor of its place, mixed.
    """

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.factors = [np.uint64((FIRST_FACTOR + j * STEP_FACTOR) % (1 << 64)) for j in range(size)]
        self.hasher = WordHasher()

    def _sums(self, hashes: np.ndarray, size: int) -> np.ndarray:
        n = len(hashes) - size + 1
        total = np.full(n, size, "uint64")
        for j in range(size):
            total += hashes[j : j + n] * self.factors[j]
        return mixed(total)

    def tokens(self, texts: list[bytes]) -> list[np.ndarray]:
        flat, starts, _ = self.hasher(b" ".join(texts).lower())
        ends = np.cumsum([len(t) + 1 for t in texts])  # lower() keeps the length of bytes
        upto = np.searchsorted(starts, ends).tolist()
        whole = self._sums(flat, self.size) if len(flat) >= self.size else flat
        out, at = [], 0
        for end in upto:
            n = end - at
            if n >= self.size:
                found = np.sort(whole[at : end - self.size + 1])
                keep = np.empty(len(found), bool)
                keep[0] = True
                np.not_equal(found[1:], found[:-1], out=keep[1:])
                out.append(found[keep])
            else:
                out.append(self._sums(flat[at:end], n) if n else _NONE)
            at = end
        return out


def node_of(tokens: np.ndarray) -> int:
    """The name of a set; 64 bits, so two of several billion sets might share one by chance."""
    return xxhash.xxh64_intdigest(tokens.tobytes(), seed=1) - (1 << 63)


def needed(n: int, percent: int) -> int:
    """Tokens a set of n must share with any set it is linked to."""
    return -(-percent * n // 100)


@dataclass
class Order:
    """The global order: which tokens are frequent (sorted)."""

    frequent: np.ndarray

    def split(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.frequent):
            return tokens, tokens[:0]
        at = np.searchsorted(self.frequent, tokens)
        at[at == len(self.frequent)] = 0
        often = self.frequent[at] == tokens
        return tokens[~often], tokens[often]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, "int32")
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays).view("int64") if arrays else np.empty(0, "int64")
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(flat), type=pa.list_(pa.field("element", pa.int64()))
    )


def token_counts(docs: DataFrame, percent: int, size: int, order: Order | None = None) -> DataFrame:
    """token, n: in how many 1-prefixes by plain hash order each token stands; equal sets of a task once.

    Given a first ``order``, the tokens behind the prefix instead, of the sets with a good share of frequent tokens
    before them: those put last, such tokens come forward, and may be as frequent.
    """

    def run(slabs):
        shingler, met = Shingler(size), set()
        for (texts,) in slabs:
            lists = []
            for tokens in shingler.tokens(as_bytes(texts)):
                n = len(tokens)
                if n < 2 or (node := node_of(tokens)) in met:
                    continue
                met.add(node)
                first = n - needed(n, percent) + 1
                if order is None:
                    lists.append(tokens[:first])
                elif len(order.split(tokens[:first])[1]) >= COMING_FORWARD * first:
                    lists.append(order.split(tokens[first:])[0])
            flat, times = np.unique(np.concatenate(lists) if lists else _NONE, return_counts=True)
            yield {"token": pa.array(flat.view("int64")), "n": pa.array(times)}

    counted = map_rows(docs, ["text"], "token long, n long", run)
    often = counted.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > FREQUENT)
    doubled = F.floor(F.log2(F.col("n") / FREQUENT)).alias("doubled")
    return materialise(often.select("token", doubled), "frequent")


def most_frequent(counts: DataFrame) -> Order:
    """At most MOST_FREQUENT tokens (8 bytes each) whatever the corpus holds: if more pass the bound, it is doubled
    until few enough do."""
    above = {r["doubled"]: r["count"] for r in counts.groupBy("doubled").count().collect()}  # 64 rows at most
    level = 0
    while sum(n for k, n in above.items() if k >= level) > MOST_FREQUENT:
        level += 1
    found = counts.where(F.col("doubled") >= level).select("token").toArrow()["token"].to_numpy()
    return Order(np.sort(found.astype("int64").view("uint64")))


def global_order(docs: DataFrame, percent: int, size: int) -> Order:
    """Which tokens are frequent. It decides how work is dealt, never what is found."""
    counts = token_counts(docs, percent, size)
    return most_frequent(counts.unionAll(token_counts(docs, percent, size, most_frequent(counts))))


def nodes(docs: DataFrame, order: Order, percent: int, size: int) -> DataFrame:
    """row, doc_id, key, node, n and the 2-prefix of every document: ``rare`` tokens, and frequent ones, ``one`` of the
    1-prefix and ``two`` the one more. Sets that a task has met before come without tokens."""
    schema = f"row long, doc_id {id_type(docs)}, key long, node long, n int, rare array<long>, one array<long>, two array<long>"

    def run(slabs):
        shingler, met = Shingler(size), set()
        for rows, ids, keys, texts in slabs:
            names, sizes, rares, ones, twos = [], [], [], [], []
            for tokens in shingler.tokens(as_bytes(texts)):
                n = len(tokens)
                sizes.append(n)
                names.append(node := node_of(tokens) if n else None)
                rare = one = two = _NONE
                if n > 1 and node not in met:  # a set of one token is linked with equal sets only
                    met.add(node)
                    plain, often = order.split(tokens)
                    first = n - needed(n, percent) + 1
                    rare = plain[:first]
                    one = often[: first - len(rare)]
                    two = often[len(one) : len(one) + 1] if len(one) else _NONE
                rares.append(rare)
                ones.append(one)
                twos.append(two)
            yield {
                "row": rows, "doc_id": ids, "key": keys, "node": names, "n": sizes,
                "rare": _lists(rares), "one": _lists(ones), "two": _lists(twos),
            }

    return map_rows(docs, ["row", "doc_id", "key", "text"], schema, run)


def shared_tokens(held: DataFrame) -> DataFrame:
    """node, n, ones (frequent tokens of the 1-prefix), last (the last rare token of the 1-prefix), token, kind (0 rare,
    1 frequent, 2 frequent and only in the 2-prefix), at (place among those of its kind) of tokens that several nodes
    hold, with ``lead``, the most central of those nodes: that with the most frequent tokens in its 1-prefix, hence
    the fewest of its own, and of these the smallest."""

    def entries(column: str, kind: int) -> Column:
        return F.transform(column, lambda t, i: F.struct(t.alias("token"), F.lit(kind).alias("kind"), i.alias("at")))

    every = F.concat(*[entries(c, k) for k, c in enumerate(("rare", "one", "two"))])
    last = F.try_element_at("rare", F.lit(-1)).alias("last")
    index = held.select("node", "n", F.size("one").alias("ones"), last, F.inline(every))
    bucket = Window.partitionBy("token")
    central = F.max(F.struct(F.col("ones"), (-F.col("node")).alias("node"))).over(bucket)
    index = index.select(
        "*",
        (-central["node"]).alias("lead"),
        F.min("node").over(bucket).alias("least"),
        F.max("node").over(bucket).alias("most"),
    )
    return index.where("least < most").drop("least", "most")


def _filter_words(names: DataFrame) -> np.ndarray:
    """A bitmap of 2^FILTER_BITS bits over ``key``, a hash: fixed in size, it only saves work."""
    bit = F.pmod(F.col("key"), F.lit(1 << FILTER_BITS))
    packed = names.select(F.shiftright(bit, 6).alias("w"), F.expr("shiftleft(1L, int(pmod(key, 64)))").alias("b"))
    rows = packed.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), "int64")
    out[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return out.view("uint64")


def token_sets(docs: DataFrame, held: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node and all its tokens, for the nodes in ``wanted`` and a few the filter lets through. Of each node one text is
    split again; others are passed over by their ``key``."""
    rows = held.where(F.size("rare") + F.size("one") > 0).join(wanted.distinct(), "node", "left_semi")
    bits = _filter_words(rows.groupBy("node").agg(F.min("key").alias("key")))

    def run(slabs):
        shingler, met = Shingler(size), set()
        for keys, texts in slabs:
            places = keys.to_numpy().view("uint64") & np.uint64((1 << FILTER_BITS) - 1)
            chosen = (bits[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) != 0
            names, lists = [], []
            for tokens in shingler.tokens(as_bytes(texts.filter(pa.array(chosen)))) if chosen.any() else ():
                if len(tokens) < 2 or (node := node_of(tokens)) in met:
                    continue
                met.add(node)
                names.append(node)
                lists.append(tokens)
            yield {"node": names, "tokens": _lists(lists)}

    return map_rows(docs, ["key", "text"], "node long, tokens array<long>", run)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough. Sets may come several times; each counts once."""
    once = sets.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
    once = once.groupBy("node").agg(F.first("tokens").alias("tokens"))
    left = pairs.join(once.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
    both = left.join(once.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    both = both.select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("sum"))
    return both.where(100 * F.col("common") >= percent * (F.col("sum") - F.col("common"))).select("a", "b")


def first_tokens(n: Column, percent: int) -> Column:
    """The length of a 1-prefix."""
    return n - F.ceil(n * percent / 100) + 1


def may_link(shared: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether sets of n and m tokens that share ``shared`` tokens of both 1-prefixes can be alike enough.

    Of the prefix that ends first in the global order all shared tokens stand in the other prefix too, so the sets
    share at most what that prefix shares and all that lies behind it.
    """
    behind = F.greatest(n - first_tokens(n, percent), m - first_tokens(m, percent))
    sized = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return sized & ((100 + percent) * (shared + behind) >= percent * (n + m))


def leaders(shared: DataFrame, percent: int) -> DataFrame:
    """a, b: each node with the leading node of the buckets it shares most, if it shares 4 in 10 tokens of its
    1-prefix with it. Near copies share more; what this leaves out is left to ``crossing``."""
    votes = shared.where("node <> lead AND kind < 2").groupBy("node", "n", "lead").agg(F.count("*").alias("votes"))
    votes = votes.where(10 * F.col("votes") >= 4 * first_tokens(F.col("n"), percent))
    best = votes.groupBy("node").agg(F.max(F.struct("votes", -F.col("lead"))).alias("m"))
    return best.select(F.col("node").alias("a"), (-F.col("m.col2")).alias("b"))


def groups(links: DataFrame) -> DataFrame:
    """node, grp: nodes joined by leader links, two links up. Leaders come before their nodes in (ones, node), so no
    links go round."""
    up = links.select(F.col("a").alias("node"), F.col("b").alias("up"))
    beyond = links.select(F.col("a").alias("up"), F.col("b").alias("top"))
    return up.join(beyond, "up", "left").select("node", F.coalesce("top", "up").alias("grp"))


def crossing(shared: DataFrame, grouped: DataFrame, percent: int) -> DataFrame:
    """a < b: the candidate pairs across groups, from buckets of a rare token or of two frequent ones.

    ``alone`` counts tokens of the 1-prefix that no partner met in the bucket shares. Where the first shared token is a
    frequent one, those are all rare ones. Otherwise they are the rare ones in no other 1-prefix, but only as far as
    the partner's own 1-prefix reaches, behind which it may hold them: all of them (``alone``) if it ends no
    sooner, and in any case those before the bucket's token (``before``), which both hold. That tells how large a
    partner may be; where a bucket has none so small, the node leaves it.
    """
    # kind 0: the place among all rare tokens less that among those met elsewhere
    along = Window.partitionBy("node", "kind").orderBy("at")
    whole = Window.partitionBy("node", "kind")
    held = shared.drop("lead").distinct().join(grouped, "node", "left")  # several tasks may have met a node
    held = held.withColumns({"met": F.count("*").over(whole), "earlier": F.row_number().over(along) - 1})
    rare_ones = first_tokens(F.col("n"), percent) - F.col("ones")
    is_rare = F.col("kind") == 0
    # where a 1-prefix ends, as far as rare tokens go; hashes are unsigned in the global order
    end = F.struct((F.col("ones") > 0).alias("all"), (F.col("last") < 0).alias("high"), "last")
    end = F.when(is_rare & (F.col("ones") == 0), end).otherwise(
        F.struct(F.lit(True).alias("all"), F.lit(True).alias("high"), F.lit(0).cast("long").alias("last"))
    )
    held = held.select(
        "node", "n", "ones", "token", "kind",
        F.when(is_rare, rare_ones - F.col("met")).otherwise(rare_ones).alias("alone"),
        F.when(is_rare, F.col("at") - F.col("earlier")).otherwise(rare_ones).alias("before"),
        end.alias("end"), F.coalesce("grp", "node").alias("grp"),
    )

    def fits(n: Column, alone: Column, m: Column) -> Column:
        return (100 + percent) * (n - alone) >= percent * (n + m)

    def unshared(x: str, end: Column) -> Column:
        """Tokens of the 1-prefix of x that a partner whose 1-prefix ends at ``end`` or later cannot share."""
        return F.when(F.col(f"{x}end") <= end, F.col(f"{x}alone")).otherwise(F.col(f"{x}before"))

    def across(index: DataFrame, *keys: str) -> DataFrame:
        """Without the nodes too far off for any in their bucket, and buckets of one group."""
        bucket = Window.partitionBy(*keys)
        near = index.withColumns({"n0": F.min("n").over(bucket), "end0": F.min("end").over(bucket)})
        near = near.where(fits(F.col("n"), unshared("", F.col("end0")), F.col("n0")))
        near = near.select("*", F.min("grp").over(bucket).alias("g0"), F.max("grp").over(bucket).alias("g1"))
        return near.where("g0 < g1").drop("g0", "g1", "n0", "end0")

    held = materialise(across(held, "token"), "crossing")

    def pairs(index: DataFrame, keys: list[str]) -> DataFrame:
        x, y = index.alias("x"), index.alias("y")
        meet = (F.col("x.node") < F.col("y.node")) & (F.col("x.grp") != F.col("y.grp"))
        for k in keys:
            meet &= F.col(f"x.{k}") == F.col(f"y.{k}")
        meet &= 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
        meet &= fits(F.col("x.n"), unshared("x.", F.col("y.end")), F.col("y.n"))
        meet &= fits(F.col("y.n"), unshared("y.", F.col("x.end")), F.col("x.n"))
        return x.join(y, meet).select(
            F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n").alias("n"), F.col("y.n").alias("m"),
            F.least("x.ones", "y.ones").alias("ones"),
        )

    rare = pairs(held.where("kind = 0"), ["token"]).groupBy("a", "b", "n", "m", "ones").agg(F.count("*").alias("c"))
    # frequent tokens are not counted pair by pair; at most all of the smaller number are shared
    rare = rare.where(may_link(F.col("c") + F.col("ones"), F.col("n"), F.col("m"), percent))

    # in the global order: hashes are unsigned there
    place = F.struct("kind", (F.col("token") < 0).alias("high"), "token")
    often = held.where("kind > 0").groupBy("node", "n", "ones", "alone", "end", "grp").agg(
        F.sort_array(F.collect_list(place)).alias("t")  # as many as the prefix holds
    )
    often = often.withColumn("t", F.transform("t", lambda x, i: F.struct(x["kind"], x["token"], i.alias("at"))))

    def with_later(x: Column) -> Column:
        """The combinations of x with what comes after it. Where they are the first two tokens a pair shares, none
        before the second but x is shared."""
        later = F.filter("t", lambda y: (y["at"] > x["at"]) & (x["kind"] == 1))
        u = x["token"]
        return F.transform(
            later,
            lambda y: F.struct(
                F.least(u, y["token"]).alias("u"),
                F.greatest(u, y["token"]).alias("v"),
                (F.col("alone") + y["at"] - 1).alias("before"),
            ),
        )

    double = often.select("node", "n", "ones", "end", "grp", F.inline(F.flatten(F.transform("t", with_later))))
    double = double.withColumn("alone", F.col("before"))
    double = materialise(across(double, "u", "v"), "combinations")
    return rare.select("a", "b").unionAll(pairs(double, ["u", "v"]).select("a", "b")).distinct()


def join(docs: DataFrame, percent: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """row, doc_id, n_shingles, component_id and keep, a row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable by links, the row's own included; ``keep`` marks one row of each
    component, that with the smallest (doc_id, row). With fewer words than a shingle the whole sequence is one
    shingle. NULL, empty and blank texts have empty sets, are linked with nothing and are kept. Equal
    sets are linked, however often they repeat. A NULL doc_id counts as larger than all others and shows only where a
    component has no other.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("key"), "text")
    order = global_order(docs.select("text"), percent, size)
    held = materialise(nodes(rows, order, percent, size), "nodes")
    shared = materialise(shared_tokens(held), "shared")

    def linked(pairs: DataFrame) -> DataFrame:
        found = token_sets(rows, held, pairs.select(F.explode(F.array("a", "b")).alias("node")), size)
        return materialise(verified(pairs, found, percent), "links")

    first = linked(materialise(leaders(shared, percent), "leaders"))
    links = first.unionByName(linked(materialise(crossing(shared, groups(first), percent), "across")))
    labels = components(links)

    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    members = held.select("row", "doc_id", "node", "n")
    by_node = members.where("node IS NOT NULL").groupBy("node").agg(F.min(key).alias("least"))
    by_node = by_node.join(labels, "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"), "least"
    )
    by_label = by_node.groupBy("label").agg(F.min("least").alias("best"))
    named = by_node.join(by_label, "label").select("node", "best")
    return members.join(named, "node", "left").select(
        "row",
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("best.id")).alias("component_id"),
        (F.col("node").isNull() | (F.col("best.row") == F.col("row"))).alias("keep"),
    )


def deduplicated(docs: DataFrame, percent: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that ``join`` keeps, all columns as they are.

    ``docs`` must be a stored table: its rows are numbered in two scans, which have to agree.
    """
    kept = join(docs, percent, size).where("keep").select("row")
    return whole_rows(docs).join(kept, "row", "left_semi").select("doc.*")
