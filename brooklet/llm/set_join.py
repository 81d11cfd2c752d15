"""Links between sets that share tokens of their prefixes: all of them, or enough to connect what is linked."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brooklet.llm.common import written
from brooklet.llm.components import components

#: Where components are all that is asked for, the sets of a token are all paired up to
#: this many, and go through hubs beyond.
LISTED = 16
#: Hubs go on while the pairs left are more than this many times the rows left, and
#: while a round links a hundredth of these rows.
PAIRS_A_ROW, HUB_ROUNDS = 8, 6
#: Tokens before a prefix token that tell where a pair has been met already.
BEFORE = ("before1", "before2", "before3")

#: Members and sets of a block, as expected numbers; members that a table of presence has columns for.
BLOCK_MEMBERS, BLOCK_SETS, COLUMNS = 1 << 14, 256, 1 << 14


def needed(n: int, similarity: int) -> int:
    """Members that a set of ``n`` shares with every set it is linked to, at least."""
    return -(-n * similarity // 100)


def shared_members(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two of ``sets`` (distinct numbers each) share, as a square table."""
    size = np.array([len(one) for one in sets])
    _, member, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, met = np.repeat(np.arange(len(sets)), size), often[member] > 1
    member, owner = (np.cumsum(often > 1) - 1)[member[met]], owner[met]
    order = np.argsort(member, kind="stable")
    member, owner = member[order], owner[order]
    shared = np.zeros((len(sets), len(sets)), np.int64)
    for first in range(0, int(member[-1]) + 1 if len(member) else 0, COLUMNS):
        part = slice(*np.searchsorted(member, [first, first + COLUMNS]))
        present = np.zeros((len(sets), min(COLUMNS, int(member[-1]) + 1 - first)), np.float32)
        present[owner[part], member[part] - first] = 1
        shared += (present @ present.T).astype(np.int64)
    np.fill_diagonal(shared, size)
    return shared


def _count_links(similarity: int):
    def count(rows: pd.DataFrame) -> pd.DataFrame:
        """key and links of the sets of one or two blocks: within a block, or from one to the other."""
        rows = rows.drop_duplicates("key")  # a set may be there twice
        shared = shared_members(rows["grams"].tolist())
        n, block = shared.diagonal(), rows["block"].to_numpy()
        linked = 100 * shared >= similarity * (n[:, None] + n - shared)
        np.fill_diagonal(linked, False)
        if rows["across"].iloc[0]:
            linked &= block[:, None] != block
        return pd.DataFrame({"key": rows["key"], "links": linked.sum(1)}).query("links > 0")

    return count


def _ends(rows: DataFrame, end: str) -> DataFrame:
    """``rows`` as those of one end of a pair: its key as ``end``, other columns with that suffix."""
    others = (F.col(c).alias(f"{c}_{end}") for c in rows.columns if c != "key")
    return rows.select(F.col("key").alias(end), *others)


class SetJoin:
    """Links of Jaccard similarity ``similarity`` hundredths or more between sets named by a key.

    A subclass gives the prefixes (token, key, n, matches; without repeated rows) and the
    sets themselves. Two linked sets must share at least min(matches) prefix tokens.
    """

    #: Columns of ``parities``, long each; none where a subclass has no such table.
    words_of_parity: tuple[str, ...] = ()

    def __init__(self, similarity: int) -> None:
        self.similarity = similarity

    def parities(self) -> DataFrame:
        """key and ``words_of_parity``: of the members that hash to a bit, whether their number is odd.

        Where two sets differ in a bit they differ in a member, so the bits that differ are
        no more than the members that do.
        """
        raise NotImplementedError

    def prefixes_of_all(self) -> DataFrame:
        """token, key, n, matches, least (matches of the token's sets): the prefix tokens that several sets have."""
        raise NotImplementedError

    def sets_of(self, ends: DataFrame) -> DataFrame:
        """key, grams of the sets whose key is in ``ends``."""
        raise NotImplementedError

    # Expressions over the sizes of sets; every prefix has n - needed + matches members.

    def _needed(self, n: str) -> str:
        return f"({self.similarity} * {n} + 99) div 100"

    def _overlap(self, n: str, m: str) -> str:
        """Members that sets of these sizes share if they are linked."""
        whole = 100 + self.similarity
        return f"({self.similarity} * ({n} + {m}) + {whole - 1}) div {whole}"

    def _asked(self, end_a: str, end_b: str) -> str:
        """Prefix members that two linked sets share, at least.

        Of what they share no more than n - prefix lies behind the prefix that ends first.
        """
        left = lambda end: f"({self._needed(f'n{end}')} - matches{end})"
        behind = f"greatest({left(end_a)}, {left(end_b)})"
        return f"greatest(least(matches{end_a}, matches{end_b}), {self._overlap(f'n{end_a}', f'n{end_b}')} - {behind})"

    def _close(self, a: str = "_a", b: str = "_b") -> str:
        """Whether two sets can be similar enough, for their sizes and the prefix members others share."""
        sizes = f"100 * least(n{a}, n{b}) >= {self.similarity} * greatest(n{a}, n{b})"
        return f"{sizes} AND least(length{a}, length{b}) >= {self._asked(a, b)}"

    def _alike(self) -> str:
        """Whether two sets, for all that their parities say, share as many members as linked ones do."""
        if not self.words_of_parity:
            return "true"
        apart = " + ".join(f"bit_count({w}_a ^ {w}_b)" for w in self.words_of_parity)
        return f"{apart} <= n_a + n_b - 2 * ({self._overlap('n_a', 'n_b')})"

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """a, b, shared, n_a, n_b of the candidates that are linked.

        Prefixes are compared first; the sets are fetched for pairs that share enough of these.
        """
        a, b = (_ends(self.lists, end) for end in "ab")
        enough = F.size(F.array_intersect("prefix_a", "prefix_b")) >= F.expr(self._asked("_a", "_b"))
        close = pairs.join(a, "a").join(b, "b").filter(enough).select("a", "b", "n_a", "n_b")
        close = written(close, "close-pairs")
        ends = close.selectExpr("a AS key").union(close.selectExpr("b AS key")).distinct()
        if self.sets is not None:
            ends = ends.join(self.sets.select("key"), "key", "left_anti")
        ends = written(ends, "ends")
        if self.sets is None or not ends.isEmpty():
            more = written(self.sets_of(ends), "sets")
            self.sets = more if self.sets is None else self.sets.unionByName(more)
        both = close.join(_ends(self.sets, "a"), "a").join(_ends(self.sets, "b"), "b")
        both = both.withColumn("shared", F.size(F.array_intersect("grams_a", "grams_b")).cast("long"))
        linked = 100 * F.col("shared") >= self.similarity * (F.col("n_a") + F.col("n_b") - F.col("shared"))
        return written(both.filter(linked).select("a", "b", "shared", "n_a", "n_b").distinct(), "links")

    def _listed(self, rows: DataFrame) -> DataFrame:
        """Pairs from different components that may share enough of the tokens of ``rows``, all rows of each.

        A set that needs k of these tokens in common with any other can leave out its k - 1
        most frequent: were the rarest that a pair shares among them, there would be
        fewer than k. It needs what it asks for (of the least demanding set it meets),
        less what it may share of tokens that are not in ``rows``.

        A pair is made where it meets first, for all that the tokens just before tell: if
        one of these is shared, so is the pair made there or even earlier.
        """
        met = rows.groupBy("key", "n", "matches").agg(
            F.count("*").alias("here"), F.min("n_least").alias("n_least"),
            F.min("matches_least").alias("matches_least"), F.max("left_most").alias("left_most"),
        )
        behind = f"greatest({self._needed('n')} - matches, left_most)"
        smallest = f"greatest(n_least, {self._needed('n')})"
        asked = f"greatest(least(matches, matches_least), {self._overlap('n', smallest)} - {behind})"
        keep = met.join(self.lists.select("key", "length"), "key").select(
            "key", F.expr(f"here - greatest(0, {asked} - (length - here) - 1)").alias("keep")
        )
        in_order = Window.partitionBy("key").orderBy("of_token", "token")
        before = {name: F.lag("token", i).over(in_order) for i, name in enumerate(BEFORE, 1)}
        kept = rows.drop("n_least", "matches_least", "left_most").join(written(keep, "keep"), "key")
        kept = kept.withColumn("rank", F.row_number().over(in_order))
        kept = kept.withColumns(before).filter("rank <= keep")
        kept = kept.select("token", "key", "n", "matches", "length", "root", *BEFORE)
        if self.words_of_parity:
            kept = kept.join(self.parities(), "key")
        kept = written(kept, "listed-rows")
        a, b = (_ends(kept, end).withColumnRenamed(f"token_{end}", "token") for end in "ab")
        pairs = a.join(b, "token").filter("a < b AND root_a <> root_b").filter(self._close())
        met = F.arrays_overlap(*(F.array(*(f"{name}_{end}" for name in BEFORE)) for end in "ab"))
        pairs = pairs.filter(self._alike()).filter(~F.coalesce(met, F.lit(False)))
        return pairs.select("a", "b").distinct()

    def links(self) -> DataFrame:
        """All linked pairs of sets (a, b: keys; shared, n_a, n_b), each once.

        As many rows as there are links, and so with the square of a group of near copies;
        ``degrees`` counts them without.
        """
        return self._verified(self._listed(self._prefix_rows()))

    def _prefix_rows(self) -> DataFrame:
        """The prefixes, with the number and bounds of a token's sets, the length of a prefix and each set its own root."""
        self.prefixes = self._promising(self._met(self._promising(self.prefixes_of_all())))
        sizes = self.prefixes.groupBy("token").agg(
            F.count("*").alias("of_token"), F.min("n").alias("n_least"), F.min("matches").alias("matches_least"),
            F.max(F.expr(f"{self._needed('n')} - matches")).alias("left_most"),
        )
        sizes = written(sizes, "sizes")
        lists = self.prefixes.groupBy("key", "n", "matches").agg(F.collect_list("token").alias("prefix"))
        self.lists, self.sets = written(lists.withColumn("length", F.size("prefix")), "lists"), None
        rows = self.prefixes.join(sizes, "token").join(self.lists.select("key", "length"), "key")
        return written(rows.withColumn("root", F.col("key")), "prefix-rows")

    def connecting(self) -> DataFrame:
        """Linked pairs of sets, as ``links`` has them, that connect all that is linked.

        Between the sets of a token that at most ``LISTED`` sets share all links are
        there; among more, those that no other link has made needless.
        """
        rows = self._prefix_rows()
        many = rows.filter(F.col("of_token") > LISTED)
        links = self._verified(self._listed(rows.filter(F.col("of_token") <= LISTED)))
        self.used, turn, more = None, 0, True
        while True:
            many = self._open(many, links)
            left = many.groupBy("token", "root").agg(F.count("*").alias("n")).groupBy("token")
            left = left.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
            pairs = (F.col("n") * F.col("n") - F.col("own")) / 2
            rows_left, pairs_left = left.agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in (F.col("n"), pairs))).first()
            if not rows_left:
                return links
            if turn == HUB_ROUNDS or not more or pairs_left <= PAIRS_A_ROW * rows_left:
                return links.unionByName(self._verified(self._listed(many)))
            found = self._verified(self._starred(many))
            links = written(links.unionByName(found), "all-links")
            turn, more = turn + 1, 100 * found.count() >= rows_left

    def degrees(self, roots: DataFrame) -> DataFrame:
        """key, links: the exact number of other sets that each linked set is linked with.

        ``roots`` (key, root) are the components of the links that ``connecting`` found, and
        two linked sets are in one component. The sets of a component are dealt into blocks,
        and a task compares all sets of two blocks, or of one: it yields a count per set, and
        no row is made for a pair. Small components share a block.
        """
        sized = roots.join(self.lists.select("key", "n"), "key")
        of_root = sized.groupBy("root").agg(F.sum("n").alias("members"), F.count("*").alias("sets"))
        blocks = f"greatest(ceil(members / {BLOCK_MEMBERS}), ceil(sets / {BLOCK_SETS}))"
        of_root = written(of_root.withColumn("blocks", F.expr(blocks)), "of-root")
        small = of_root.filter("blocks = 1").agg(F.sum("members").alias("members"), F.sum("sets").alias("sets"))
        together = small.select(F.expr(f"coalesce({blocks}, 1)")).first()[0]
        dealt = sized.select("key", "root").join(of_root.select("root", "blocks"), "root")
        mine = f"IF(blocks = 1, pmod(xxhash64(root), {together}), pmod(xxhash64(key), blocks))"
        dealt = written(dealt.withColumn("block", F.expr(mine)), "dealt")
        placed = dealt.join(self.sets.select("key", "grams"), "key")
        placed = placed.withColumn("other", F.explode(F.expr("IF(blocks = 1, array(block), sequence(0L, blocks - 1))")))
        placed = placed.selectExpr(
            "IF(blocks = 1, NULL, root) AS root", "least(block, other) AS one", "greatest(block, other) AS two",
            "block", "block <> other AS across", "key", "grams",
        )
        counted = placed.groupBy("root", "one", "two").applyInPandas(_count_links(self.similarity), "key long, links long")
        return counted.groupBy("key").agg(F.sum("links").alias("links"))

    def _met(self, rows: DataFrame) -> DataFrame:
        """``rows`` without the tokens left alone, with the least matches of the sets of a token."""
        least = rows.groupBy("token").agg(F.min("matches").alias("least"), F.count("*").alias("of_token"))
        met = rows.join(written(least.filter("of_token > 1"), "least"), "token")
        return written(met.select("token", "key", "n", "matches", "least"), "met")

    def _promising(self, met: DataFrame) -> DataFrame:
        """``met`` without ``least`` and the sets that share too few tokens for any link.

        A set meets only sets of its tokens, so it needs as many shared tokens as it asks
        for itself, or as the least of these sets does.
        """
        enough = met.groupBy("key", "matches").agg(F.count("*").alias("length"), F.min("least").alias("least"))
        enough = enough.filter(F.col("length") >= F.least("matches", "least")).select("key")
        return written(met.drop("least").join(written(enough, "enough"), "key", "left_semi"), "promising")

    def _starred(self, many: DataFrame) -> DataFrame:
        """Pairs of a hub of each token, a new one each time, and the sets that share it.

        The hub has the fewest prefix members to itself, as a text that others were made from.
        """
        own = F.expr(f"n - {self._needed('n')} + matches - length").alias("own")
        free = many if self.used is None else many.join(self.used, ["token", "key"], "left_anti")
        names = ("key", "n", "matches", "length", "root")
        hubs = free.groupBy("token").agg(F.min(F.struct(own, *names)).alias("hub"))
        hubs = hubs.select("token", F.col("hub.key").alias("hub"), *(F.col(f"hub.{c}").alias(f"{c}_hub") for c in names[1:]))
        hubs = written(hubs, "hubs")
        taken = hubs.selectExpr("token", "hub AS key")
        self.used = taken if self.used is None else self.used.unionByName(taken)
        pairs = many.join(hubs, "token").filter("key <> hub AND root <> root_hub").filter(self._close("", "_hub"))
        return pairs.selectExpr("least(key, hub) AS a", "greatest(key, hub) AS b").distinct()

    def _open(self, many: DataFrame, links: DataFrame) -> DataFrame:
        """Rows of the tokens whose sets are not yet all in one component, with their roots."""
        roots = written(components(links), "roots")
        named = roots.selectExpr("node AS key", "root AS new_root")
        rows = many.join(named, "key", "left").withColumn("root", F.coalesce("new_root", "key")).drop("new_root")
        rows = written(rows, "rooted")
        open_ = rows.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        return written(rows.join(written(open_.filter("low < high").select("token"), "open"), "token"), "open-rows")
