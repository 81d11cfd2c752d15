"""Self-join of documents on the Jaccard similarity of their word 5-grams.

Documents with the same set of shingles form a class, and only classes are compared, so
any number of copies costs one. Classes are compared through prefixes with an adaptive
number of matches: with the shingles of a set of n in one global order, sets of
similarity s or more share at least l of their first n - ceil(s n) + l shingles, for any
l both have chosen. Each class picks the l that costs least by an estimate from the
shingles' frequencies; a pair is verified only if its prefixes share min(l, l') shingles.

The order puts frequent shingles last. Frequencies come from all documents: each task
counts the shingles that recur among the documents it reads together, and the sums of
the ``FREQUENT`` most frequent go along with the tasks (3 MB at most). An estimate that
is off costs time only; any order gives the same result.

``links`` lists all pairs of the classes that share a shingle of their prefixes, and finds
every link. A pair is not listed where the parities of its sets' shingles differ in more
bits than linked sets can differ in shingles.

For components no links are needed between classes that others connect: pairs of a shingle that few classes share are all listed. For a shingle that many
share (copies with small edits) each class is first compared with one hub; members that are
linked by then need no comparison. Pairs of such groups that are still in different
components go through further hubs, and in the end are listed one and all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.common import bounded, columns, id_text, named_text, slices, small_batches, written
from brooklet.llm.components import components
from brooklet.llm.set_join import SetJoin, needed

WORDS = 5
#: Similarity in hundredths.
SIMILARITY = 75
FREQUENT, LEAST_FREQUENCY = 1 << 18, 3
#: Shingles that a task counts together: 24 MB of hashes.
COUNTED_TOGETHER = 3_000_000
#: Matches asked for, at most; other sets expected to share a shingle that is not
#: frequent; shingles verified in the time that one prefix shingle takes to be sent.
MOST_MATCHES, EXPECTED, VERIFY_RATE = 128, 0.1, 32.0

#: Words of 64 bits that hold the parities of a set's shingles.
PARITIES = ("p0", "p1", "p2", "p3")

PRIME = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- shingles


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles, as the join defines them.

    Words end at ASCII white space, A-Z are lower-cased (bytes know no other case).
    With fewer than ``words`` words their sequence is the one shingle; without any
    there is none.
    """
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    n = min(words, len(hashed))
    out = np.full(len(hashed) - n + 1, n, np.uint64)
    for i in range(n):
        out = out * PRIME + hashed[i : len(hashed) - n + 1 + i]
    return np.unique(_mix(out))


def set_key(found: np.ndarray, salt: int) -> tuple[int, bytes]:
    """A 64-bit and a 128-bit key of a set."""
    both = hashlib.blake2b(found.tobytes(), digest_size=24, salt=salt.to_bytes(8, "little")).digest()
    return int.from_bytes(both[:8], "little", signed=True), both[8:]


def parity(found: np.ndarray) -> list[int]:
    """Bits that are set where an odd number of shingles falls, as signed words of 64."""
    bits = 64 * len(PARITIES)
    odd = np.bincount((found % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


# ---------------------------------------------------------------- tasks


def _classes(words: int, salt: int):
    """Per document its set's keys and size; per shingle how often it recurs nearby."""

    def recurring(sets: list[np.ndarray]) -> pd.DataFrame:
        token, often = np.unique(np.concatenate(sets), return_counts=True)
        token, often = token[often > 1], often[often > 1]
        none = pd.array([None] * len(token), dtype="Int64")
        rows = pd.DataFrame({"doc_id": None, "n": often, "key": none, "full": None, "token": token.view(np.int64)})
        return rows.assign(**{name: none for name in PARITIES})

    def classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets, held, done = [], 0, set()
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = shingles(text, words)
                key, full = set_key(found, salt)
                rows.append((doc_id, len(found), key, full, *parity(found)))
                if key not in done:
                    done.add(key)
                    sets.append(found)
                    held += len(found)
            out = pd.DataFrame(rows, columns=["doc_id", "n", "key", "full", *PARITIES])
            out.insert(4, "token", pd.array([None] * len(out), dtype="Int64"))
            yield out
            if held > COUNTED_TOGETHER:
                yield recurring(sets)
                sets, held, done = [], 0, set()
        if held:
            yield recurring(sets)

    return classes


def choose_prefix(n: int, cost: np.ndarray, similarity: int) -> tuple[int, int]:
    """Prefix length and matches wanted, for the candidates that each shingle in order costs."""
    shared = needed(n, similarity)
    base = n - shared
    most = min(shared, MOST_MATCHES)
    length, matches = np.arange(base + 1, base + most + 1), np.arange(1, most + 1)
    met = np.cumsum(cost[: base + most])[base : base + most] + EXPECTED * length
    best = int(np.argmin(length + met + met / matches * n / VERIFY_RATE))
    return int(length[best]), int(matches[best])


def _prefixes(words: int, similarity: int, salt: int, frequent):
    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, often = frequent.value
        for batch in slices(batches):
            parts, rows, done = [], [], set()
            for text in batch["text"]:
                found = shingles(text, words)
                key, _ = set_key(found, salt)
                if not len(found) or key in done:
                    continue
                done.add(key)
                weight = np.zeros(len(found), np.int64)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, found), len(tokens) - 1)
                    weight = np.where(tokens[at] == found, often[at], 0)
                    if weight.any():
                        order = np.lexsort((found, weight))
                        found, weight = found[order], weight[order]
                length, matches = choose_prefix(len(found), weight, similarity)
                parts.append(found[:length])
                rows.append((key, len(found), matches, length))
            if rows:
                key, n, matches, length = map(np.array, zip(*rows, strict=True))
                yield pd.DataFrame(
                    {
                        "token": np.concatenate(parts).view(np.int64),
                        "key": np.repeat(key, length),
                        "n": np.repeat(n, length),
                        "matches": np.repeat(matches, length),
                    }
                )

    return prefixes


def _sets(words: int, salt: int):
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            found = {}
            for text in batch["text"]:
                one = shingles(text, words)
                found[set_key(one, salt)[0]] = one.view(np.int64)
            yield pd.DataFrame({"key": list(found), "grams": list(found.values())})

    return sets


# ---------------------------------------------------------------- plan


class NgramJoin(SetJoin):
    """One join over ``docs``; the tables it needs are written as it goes on."""

    words_of_parity = PARITIES

    def __init__(self, docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> None:
        super().__init__(similarity)
        self.docs, self.words = id_text(docs), words
        self.spark = docs.sparkSession
        small_batches(self.spark)
        self.salt = 0
        while not self._find_classes():
            self.salt += 1

    def _find_classes(self) -> bool:
        """False in the event that two sets share a 64-bit key."""
        schema = "doc_id string, n long, key long, full binary, token long, " + ", ".join(f"{p} long" for p in PARITIES)
        rows = named_text(self.docs).mapInPandas(_classes(self.words, self.salt), schema)
        rows = written(rows.withColumn("doc_id", F.col("doc_id").cast("bigint")), "classes")
        self.rows = rows.filter("token IS NULL").select("doc_id", "n", "key", "full", *PARITIES)
        self.recurring = rows.filter("token IS NOT NULL").select("token", "n")
        named = self.rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("key")
        named = named.agg(
            F.min("doc_id").alias("first"), F.first("n").alias("n"),
            F.min("full").alias("full"), F.max("full").alias("other"), *(F.first(p).alias(p) for p in PARITIES),
        )
        self.named = written(named, "named")
        return self.named.filter("full <> other").isEmpty()

    def parities(self) -> DataFrame:
        return self.named.select("key", *PARITIES)

    def _frequent(self) -> tuple[np.ndarray, np.ndarray]:
        often = self.recurring.groupBy("token").agg(F.sum("n").alias("n"))
        often = written(often.filter(F.col("n") >= LEAST_FREQUENCY), "frequent")
        # The least frequency that at most FREQUENT shingles reach, from counts of counts.
        steps = often.groupBy(F.floor(F.log("n") * 8).alias("step")).count().orderBy(F.desc("step"))
        total, least = 0, None
        for row in steps.collect():  # a row per power of e ** (1/8): some hundreds at most
            total += row["count"]
            if total > FREQUENT:
                break
            least = row["step"]
        if least is None:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        top = often.filter(F.floor(F.log("n") * 8) >= least).toPandas()
        token = top["token"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(token)
        return token[order], top["n"].to_numpy(np.int64)[order]

    def prefixes_of_all(self) -> DataFrame:
        """token, key, n, matches, least: prefixes, of the shingles that several classes have in theirs."""
        frequent = self.spark.sparkContext.broadcast(self._frequent())
        held = self.docs.filter("doc_id IS NOT NULL")
        made = _prefixes(self.words, self.similarity, self.salt, frequent)
        rows = written(held.mapInPandas(made, "token long, key long, n long, matches int"), "prefixes")
        ends = rows.groupBy("token").agg(
            F.min("key").alias("low"), F.max("key").alias("high"), F.min("matches").alias("least")
        )
        shared = written(ends.filter("low < high").select("token", "least"), "shared")
        rows = rows.join(shared, "token").select("token", "key", "n", "matches", "least")
        return written(rows.distinct(), "shared-prefixes")

    def sets_of(self, ends: DataFrame) -> DataFrame:
        wanted = ends.join(self.named.select("key", "first"), "key").select(F.col("first").alias("doc_id"))
        texts = self.docs.join(bounded(written(wanted, "wanted")), "doc_id", "left_semi")
        sets = texts.mapInPandas(_sets(self.words, self.salt), "key long, grams array<long>")
        # A doc_id may stand for several texts, and repeated rows may give a set twice.
        return sets.join(ends, "key", "left_semi")

    def roots(self, links: DataFrame) -> DataFrame:
        """key, root: the component of each class that is linked."""
        return written(components(links).selectExpr("node AS key", "root"), "class-roots")

    def components(self, links: DataFrame) -> DataFrame:
        """doc_id, n_shingles, component_id, links (of its class, in ``links``) of every row."""
        degree = links.selectExpr("a AS key").union(links.selectExpr("b AS key")).groupBy("key")
        return self.rows_in(self.roots(links), degree.agg(F.count("*").alias("links")))

    def rows_in(self, roots: DataFrame, degree: DataFrame) -> DataFrame:
        """doc_id, n_shingles, component_id, links of every row; ``degree``: key, links."""
        rooted = self.named.select("key", "first").join(roots, "key", "left")
        rooted = written(rooted.withColumn("root", F.coalesce("root", "key")), "rooted")
        least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
        of_class = rooted.join(written(least, "least"), "root").join(degree, "key", "left")
        of_class = written(of_class.selectExpr("key", "component_id", "links"), "of-class")
        rows = self.rows.select("doc_id", F.col("n").alias("n_shingles"), "key")
        alone = F.col("n_shingles") == 0
        return rows.join(of_class, "key", "left").select(
            "doc_id",
            "n_shingles",
            F.when(alone | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce("links", F.lit(0)).alias("links"),
        )


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """Every row of ``docs``: doc_id, n_shingles, component_id, links.

    ``component_id`` is the smallest doc_id that links of the given similarity reach, the
    row's own included. ``links`` is the number of other sets that the row's set is linked
    with, without its copies. A null or empty text, or one of white space, has no shingles and is linked with nothing.
    Rows without a doc_id are linked with nothing and get a null component. Repeated rows
    are in one component as any copies are. Very long texts are shingled whole. An empty
    table gives an empty one. Only doc_id and text are looked at.
    """
    join = NgramJoin(docs, words, similarity)
    roots = join.roots(join.connecting())
    return join.rows_in(roots, join.degrees(roots))


def deduplicated(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """One row of each component, all columns: that of the smallest doc_id.

    Of several rows with that doc_id all stay, for they are one document. Rows without a doc_id stay.
    """
    join = NgramJoin(docs, words, similarity)
    found = join.components(join.connecting()).groupBy("doc_id")
    # A doc_id with several texts stays if one of them leads its component.
    found = found.agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("leads"))
    dropped = written(found.filter("NOT leads").select("doc_id"), "dropped")
    return docs.join(bounded(dropped), "doc_id", "left_anti").select(*columns(docs))
