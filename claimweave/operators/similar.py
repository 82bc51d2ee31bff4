"""Similarity searches: nearest above a threshold, pairs above a threshold.

Vectors: equal vectors are first folded into one row, so a group of copies costs
nothing.  The rest meet in cells (``cells.py``), exactly.  Texts: short ones meet on what is left of
them without one or two characters, longer ones on pieces without one, long ones on one of their rarest
character grams; none loses a pair.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.settle import settled
from claimweave.functions.text import any_of, content_words, negation_parity
from claimweave.functions.vectors import direction, with_token_vector
from claimweave.operators.cells import joined, meet
from claimweave.params import DEFAULT, Params
from claimweave.session import durable, written


# ids in one list where a vector stands for all its copies
COPIES = 1024


def embed_text(rows: DataFrame, words: Column, dims: int = 64) -> DataFrame:
    """Default embedding; a user's own model goes through ``extract.call_model``."""
    return with_token_vector(rows, words, "embedding", dims)


def directed(vectors: DataFrame, key: str, group: Column | None = None) -> DataFrame:
    """(id, v, k, g): each vector at unit length, packed, with a hash that its copies share; NULL vectors are left out.

    A zero vector has no direction, so it is nobody's copy: its hash is its own.
    Written in compressed columns: copies that lie together take little room, and most steps read no vector.
    """
    turned = vectors.filter(F.col("embedding").isNotNull()).select(F.col(key).alias("id"), direction("embedding").alias("_d"), (F.lit("") if group is None else group).alias("g"))
    return written(turned.select("id", "_d.v", F.when(F.col("_d.none"), F.concat(F.lit("zero "), "id")).otherwise(F.col("_d.k")).alias("k"), "g"))


def fold_copies(rows: DataFrame) -> DataFrame:
    """One row per distinct vector of ``directed`` rows: smallest id and number of copies."""
    return rows.groupBy("k", "g").agg(
        F.min("id").alias("id"), F.any_value("v").alias("v"), F.count(F.lit(1)).alias("copies")
    )


def similar_pairs(vectors: DataFrame, key: str, above: float, params: Params = DEFAULT) -> DataFrame:
    """Pairs of distinct vectors with cosine strictly above ``above``.

    Columns a, b (smallest ids of the two vectors, a before b), copies of each,
    similarity.  Equal vectors are one row here; ``fold_copies`` names the group.
    """
    return pairs_of(directed(vectors, key), above, params)


def pairs_of(rows: DataFrame, above: float, params: Params = DEFAULT) -> DataFrame:
    """``similar_pairs`` of rows that are ``directed`` already."""
    folded = written(fold_copies(rows))
    pairs = meet(folded, None, above, seed=params.seed)
    copies = folded.select("id", "copies")
    return (
        pairs.join(copies.select(F.col("id").alias("a"), F.col("copies").alias("copies_a")), "a")
        .join(copies.select(F.col("id").alias("b"), F.col("copies").alias("copies_b")), "b")
        .select("a", "b", "copies_a", "copies_b", "similarity")
    )


def every_pair(vectors: DataFrame, key: str, above: float, params: Params = DEFAULT) -> DataFrame:
    """All pairs of ids (a, b, similarity), a before b, with cosine strictly above ``above``: those between copies too.

    Distinct vectors are searched as in ``similar_pairs``; then each stands for all its
    rows again.  The rows of a vector travel in lists of about ``COPIES``, and a pair of
    lists is a task's work, so a vector with very many copies is spread over the tasks.
    An id that comes several times has its pairs as often.
    """
    rows = directed(vectors, key).filter(F.col("id").isNotNull())
    folded = written(fold_copies(rows).withColumn("cuts", F.ceil(F.col("copies") / COPIES).cast("int")))
    # distinct vectors go by their hash, since an id may come with several
    met = meet(folded.select(F.col("k").alias("id"), "v", "g"), None, above, seed=params.seed).withColumnRenamed("similarity", "s")
    cuts = folded.select("k", "cuts")
    part = F.pmod(F.xxhash64("id"), "cuts").cast("int")
    lists = rows.select("id", "k").join(cuts, "k").select("id", "k", part.alias("part")).groupBy("k", "part").agg(F.collect_list("id").alias("ids"))

    def listed(mark: str) -> DataFrame:
        return lists.select(F.col("k").alias(mark), F.col("part").alias(f"{mark}_part"), F.col("ids").alias(f"{mark}_ids"))

    def parts(cuts: Column) -> Column:
        return F.sequence(F.lit(0), cuts - 1)

    apart = (
        met.join(cuts.select(F.col("k").alias("a"), F.col("cuts").alias("a_cuts")), "a")
        .join(cuts.select(F.col("k").alias("b"), F.col("cuts").alias("b_cuts")), "b")
        .select("a", "b", "s", F.explode(parts(F.col("a_cuts"))).alias("a_part"), "b_cuts")
        .select("a", "b", "s", "a_part", F.explode(parts(F.col("b_cuts"))).alias("b_part"))
    )
    alike = folded.filter((F.col("copies") > 1) & (F.lit(1.0) > above)).select(
        F.col("k").alias("a"), F.col("k").alias("b"), F.lit(1.0).alias("s"), F.explode(parts(F.col("cuts"))).alias("a_part"), "cuts"
    ).select("a", "b", "s", "a_part", F.explode(F.sequence("a_part", F.col("cuts") - 1)).alias("b_part"))
    # by number, since a pair of lists is little to read and much to write
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = apart.unionByName(alike).join(listed("a"), ["a", "a_part"]).join(listed("b"), ["b", "b_part"])
    dealt = tiles.repartition(tasks, "a", "b", "a_part", "b_part").withColumn("one", (F.col("a") == F.col("b")) & (F.col("a_part") == F.col("b_part")))
    found = dealt.select("s", "one", "b_ids", F.explode("a_ids").alias("x")).select("s", "one", "x", F.explode("b_ids").alias("y"))
    # within one list both orders are met
    return found.filter(F.when(F.col("one"), F.col("x") < F.col("y")).otherwise(F.col("x") != F.col("y"))).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.col("s").alias("similarity")
    )


def links_of(rows: DataFrame, above: float, params: Params = DEFAULT) -> DataFrame:
    """Links (a, b) that join the same ids as ``pairs_of`` does, some for each id however many pairs there are."""
    return joined(meet(written(fold_copies(rows)), None, above, answer="forest", seed=params.seed))


def vector_members(vectors: DataFrame, key: str) -> DataFrame:
    """(vector_id, member_id): the ids that ``similar_pairs`` folds into one, each with the smallest of them."""
    rows = directed(vectors, key)
    return rows.join(fold_copies(rows).select("k", "g", F.col("id").alias("vector_id")), ["k", "g"]).select(
        "vector_id", F.col("id").alias("member_id")
    )


def nearest_above(
    queries: DataFrame,
    base: DataFrame,
    query_id: str,
    base_id: str,
    above: float,
    at_least: bool = False,
    same: str | None = None,
    params: Params = DEFAULT,
) -> DataFrame:
    """Nearest base vector per query with cosine above the threshold, ties to the smaller id.

    Queries with none do not appear.  ``same`` names a column that must be equal
    on both sides; it becomes part of the grouping.  Equal queries are looked up once.
    """
    group = F.coalesce(F.col(same).cast("string"), F.lit("")) if same else F.lit("")

    asked = directed(queries, query_id, group)
    folded = written(fold_copies(asked))
    known = written(fold_copies(directed(base, base_id, group)))
    pairs = meet(folded, known, above, at_least, "best", params.seed)
    ranked = F.struct((-F.round("similarity", 9)).alias("far"), F.col("b").alias("b"), "similarity")
    best = pairs.groupBy("a").agg(F.min(ranked).alias("best")).select(
        F.col("a").alias("id"), F.col("best.b").alias("_near"), F.col("best.similarity").alias("similarity")
    )
    found = folded.join(best, "id").select("k", "g", "_near", "similarity")
    return asked.join(found, ["k", "g"]).select(F.col("id").alias(query_id), F.col("_near").alias(base_id), "similarity")


def match_or_new(beliefs: DataFrame, nearest: DataFrame) -> DataFrame:
    """Every belief with its nearest canonical, or NULL and ``is_new``."""
    return beliefs.select("belief_id").join(nearest, "belief_id", "left").withColumn("is_new", F.col("canonical_id").isNull())


# --- texts -----------------------------------------------------------------------

def _allowed(length: Column, ratio: float) -> Column:
    """Most edits two texts may differ by, the longer having ``length`` characters."""
    return F.floor(length * (1.0 - ratio) + 1e-9).cast("int")


def gram_size(ratio: float) -> int:
    """Longest grams for which any two texts within the ratio still share one.

    e edits change at most q*e of the n - q + 1 grams of a text of n characters.
    """
    def safe(q: int) -> bool:
        edits = ((n, math.floor(n * (1.0 - ratio) + 1e-9)) for n in range(1, 2000))
        return all(n - q + 1 - q * e >= 1 for n, e in edits if e)

    return next(q for q in (4, 3, 2, 1) if q == 1 or safe(q))


# texts that may differ by so many edits meet on what is left without these characters; texts of one task
DELETED, TASK_TEXTS = 2, 20_000
# texts of so many characters at most that may differ by so many edits meet on their pieces
PIECED, PIECED_CHARS = 5, 64


def _left_without(text: Column, n: Column, k: int) -> Column:
    """All that is left of a text of ``n`` characters without ``k`` of them."""

    def cut(kept: list[Column], start: Column, k: int) -> Column:
        if not k:
            return F.array(F.concat(*kept, F.substring(text, start, n)))
        places = F.sequence(start, n - (k - 1))
        return F.flatten(F.transform(places, lambda i: cut([*kept, F.substring(text, start, i - start)], i + 1, k - 1)))

    return cut([], F.lit(1), k)


def _met_on_rest(base: DataFrame, ratio: float) -> DataFrame:
    """Pairs of ``base`` rows of which the longer allows ``DELETED`` edits at most, as (l_id, l_t, l_n, r_id, r_t, r_n).

    Two texts of m and n characters, m the more, that are e edits apart or less have
    something in common that is left of the one without e characters and of the other
    without e - (m - n).  They meet on the hash of that and m; what few texts have in
    common with others costs their number and not its square.
    """
    named = base.withColumn("h", F.xxhash64("id", "t"))
    tasks = _tasks(base)

    def keys(short: int) -> Column:
        """Of a text that is ``short`` characters shorter than the other."""
        m = F.col("n") + short
        edits, out = _allowed(m, ratio), F.array().cast("array<bigint>")
        for k in range(DELETED - short + 1):
            left = F.transform(_left_without(F.col("t"), F.col("n"), k), lambda x: F.xxhash64(x, m, "parity"))
            out = F.when(edits == k + short, F.array_distinct(left)).otherwise(out)
        return F.transform(out, lambda x: F.struct(x.alias("key"), F.lit(short).alias("short")))

    every = F.concat(*[keys(short) for short in range(DELETED + 1)])
    # one exchange serves both sides
    keyed = named.repartition(tasks).select("h", F.inline(every)).repartition(tasks, "key")
    met = keyed.toDF("l_h", "key", "l_short").join(keyed.toDF("r_h", "key", "r_short"), "key")
    met = met.filter((F.col("l_h") < F.col("r_h")) & (F.least("l_short", "r_short") == 0)).select("l_h", "r_h").distinct()
    return _in_full(met, named)


def _tasks(base: DataFrame) -> int:
    return max(64, -(-base.count() // TASK_TEXTS))


def _in_full(met: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of ``named`` that the pairs (l_h, r_h) stand for, the longer one or that of the smaller id first."""
    sides = [named.select(*[F.col(c).alias(f"{mark}_{c}") for c in ("h", "id", "t", "n")]) for mark in "lr"]
    pairs = met.join(sides[0], "l_h").join(sides[1], "r_h")
    turned = (F.col("l_n") < F.col("r_n")) | ((F.col("l_n") == F.col("r_n")) & (F.col("l_id") > F.col("r_id")))

    def ordered(mark: str) -> list[Column]:
        other = "lr".replace(mark, "")
        return [F.when(turned, F.col(f"{other}_{c}")).otherwise(F.col(f"{mark}_{c}")).alias(f"{mark}_{c}") for c in ("id", "t", "n")]

    return pairs.filter((F.col("l_n") != F.col("r_n")) | (F.col("l_id") != F.col("r_id"))).select(*ordered("l"), *ordered("r"))


@cache
def pieces(ratio: float) -> tuple[int, list[tuple], list[tuple]]:
    """Most edits of the pairs that meet on pieces; (n, e, i, start, length) of pieces of texts, and of what they may be in others.

    A text of m characters that allows e edits is cut into e // 2 + 1 pieces, so one of them
    has one edit at most.  In a text that is ``short`` characters shorter it begins ``x`` places on and
    is ``d`` longer only if that and what it means for what follows is within e edits.
    """
    def allowed(n: int) -> int:
        return math.floor(n * (1.0 - ratio) + 1e-9)

    most = DELETED
    while most < PIECED and allowed(PIECED_CHARS + 1) > most + 1:
        most += 1
    own, others = set(), set()
    for m in range(1, PIECED_CHARS + 1):
        e = allowed(m)
        if not DELETED < e <= most:
            continue
        k = e // 2 + 1
        for i in range(k):
            at, end = m * i // k, m * (i + 1) // k
            own.add((m, e, i, at, end - at))
            for short, x, d in itertools.product(range(e + 1), range(-e, e + 1), (-1, 0, 1)):
                n, start, length = m - short, at + x, end - at + d
                inside = start >= 0 and length >= 0 and start + length <= n and (i > 0 or x == 0) and (i < k - 1 or start + length == n)
                if inside and abs(x) + abs(d) + abs(short + x + d) <= e:
                    others.add((n, e, i, start, length))
    return most, sorted(own), sorted(others)


def _met_on_pieces(base: DataFrame, ratio: float) -> DataFrame:
    """Pairs of ``base`` rows of which the longer allows more than ``DELETED`` and few edits; columns as of ``_met_on_rest``.

    One piece of the longer text has one edit at most (see ``pieces``), so it and what it
    became in the other have something in common that is left of them without a character at most.
    """
    _, own, others = pieces(ratio)
    named = base.withColumn("h", F.xxhash64("id", "t"))
    tasks, schema = _tasks(base), "n int, e int, i int, start int, length int"

    def keyed(mark: str, spec: list[tuple]) -> DataFrame:
        rows = named.repartition(tasks).join(base.sparkSession.createDataFrame(spec, schema), "n").withColumn(
            "piece", F.substring("t", F.col("start") + 1, F.col("length"))
        )
        rest = F.concat(F.array("piece"), F.when(F.col("length") > 0, _left_without(F.col("piece"), F.col("length"), 1)).otherwise(F.array().cast("array<string>")))
        keys = F.transform(F.array_distinct(rest), lambda x: F.xxhash64(x, "e", "i", "parity"))
        return rows.select(F.col("h").alias(f"{mark}_h"), F.col("n").alias(f"{mark}_n"), F.col("e").alias(f"{mark}_e"), F.explode(keys).alias("key"))

    met = keyed("l", own).repartition(tasks, "key").join(keyed("r", others).drop("r_e").repartition(tasks, "key"), "key")
    near = F.col("l_n").between(F.col("r_n"), F.col("r_n") + F.col("l_e"))
    met = met.filter(near & (F.col("l_h") != F.col("r_h"))).select(F.least("l_h", "r_h").alias("l_h"), F.greatest("l_h", "r_h").alias("r_h")).distinct()
    return _in_full(met, named)


def _met_on_grams(base: DataFrame, ratio: float, q: int, most: int) -> DataFrame:
    """Pairs of ``base`` rows of which the longer allows more than ``most`` edits; columns as of ``_met_on_rest``.

    e edits change at most q*e grams of q characters, so two texts within e edits of
    each other share one of their q*e + 1 rarest grams.  Joining on those alone loses
    no pair, and a gram that very many texts hold is among the rarest of almost none.
    """
    # the other text may be longer and so allow more edits
    longest = F.greatest(F.col("n"), F.floor(F.col("n") / ratio + 1e-9).cast("int"))
    base = base.filter(_allowed(longest, ratio) > most)
    grams = F.transform(F.sequence(F.lit(1), F.col("n") - (q - 1)), lambda i: F.substring(F.col("t"), i, F.lit(q)))
    counted = (
        base.select("id", F.explode(grams).alias("g"))
        .groupBy("id", "g")
        .agg(F.count(F.lit(1)).cast("int").alias("times"))
        # the k-th occurrence of a gram in a text counts as a gram of its own; two
        # grams with one hash only bring a pair that the check below turns away
        .select("id", "g", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("k"))
        .select("id", F.xxhash64("g", "k").alias("gram"))
    )
    rarity = counted.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    ranked = counted.join(rarity, "gram").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("grams")
    )
    need = F.array_max(
        F.transform(F.sequence(F.col("n"), longest), lambda m: _allowed(m, ratio) * q + 1 - (m - F.col("n")))
    )
    rarest = F.transform(F.slice("grams", F.lit(1), F.greatest(F.lit(1), need)), lambda x: x["gram"])
    prefix = durable(base.join(ranked, "id").select("id", "t", "n", "parity", rarest.alias("pre")))

    # lengths in bands that grow by the ratio: the longer text of a pair lies in the
    # band of the shorter one or in the next
    def band(n: Column) -> Column:
        return F.floor(F.log(n.cast("double")) / math.log(1 / ratio) + 1e-9).cast("int") if ratio < 1 else n

    def spread(mark: str, bands: Column) -> DataFrame:
        cols = [F.col(c).alias(f"{mark}_{c}") for c in prefix.columns]
        return prefix.select(*cols, F.explode("pre").alias("_gram"), F.col("parity").alias("_parity"), bands.alias("_bands")).select(
            "*", F.explode("_bands").alias("_band")
        ).drop("_bands")

    n_max = F.col("l_n")
    return (
        spread("l", F.array(band(F.col("n"))))
        .filter(_allowed(n_max, ratio) > most)
        .join(spread("r", F.sequence(band(F.col("n")), band(longest))), ["_gram", "_parity", "_band"])
        .filter((F.col("l_n") > F.col("r_n")) | ((F.col("l_n") == F.col("r_n")) & (F.col("l_id") < F.col("r_id"))))
        .filter(n_max - F.col("r_n") <= _allowed(n_max, ratio))
        # a pair that shares several grams is checked at one of them
        .filter(F.array_min(F.array_intersect("l_pre", "r_pre")) == F.col("_gram"))
        .select("l_id", "l_t", "l_n", "r_id", "r_t", "r_n")
    )


def fuzzy_pairs(texts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Pairs of distinct texts with Levenshtein ratio at or above the threshold.

    ``texts`` has one row per distinct ``norm_text`` and its ``canonical_id``.
    Texts that differ in negation never pair.
    """
    ratio, q = params.fuzzy_ratio, gram_size(params.fuzzy_ratio)
    words = F.split("norm_text", " ")
    base = durable(
        texts.select(
            F.col("canonical_id").alias("id"),
            F.col("norm_text").alias("t"),
            F.length("norm_text").alias("n"),
            negation_parity(words, params).alias("parity"),
        ).filter((F.col("n") >= q) & F.col("canonical_id").isNotNull())
    )
    n_max = F.col("l_n")
    most, own, _ = pieces(ratio)
    met = _met_on_rest(base, ratio).unionByName(_met_on_grams(base, ratio, q, most))
    if own:
        met = met.unionByName(_met_on_pieces(base, ratio))
    checked = settled(met, {"edits": F.levenshtein(F.col("l_t"), F.col("r_t"))})
    swap = F.col("l_id") > F.col("r_id")
    return checked.filter(F.col("edits") <= _allowed(n_max, ratio)).select(
        F.least("l_id", "r_id").alias("a"),
        F.greatest("l_id", "r_id").alias("b"),
        F.when(swap, F.col("r_t")).otherwise(F.col("l_t")).alias("text_a"),
        F.when(swap, F.col("l_t")).otherwise(F.col("r_t")).alias("text_b"),
        (1 - F.col("edits") / n_max).alias("ratio"),
    )


# --- opposition ------------------------------------------------------------------


# least sizes of the classes of word sets; sets of the sizes up to SMALL meet on two words where they must share two
CLASSES = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 18, 22, 27, 33, 40, 50, 64, 80, 100, 150, 250, 500)
SMALL = 8


def _size_class(n: Column) -> Column:
    return F.array_max(F.filter(F.array(*[F.lit(c) for c in CLASSES]), lambda c: c <= n))


def _class_rules(n: Column, own: Column, low: int, at_least: float) -> tuple[Column, Column, Column]:
    """Of a set and a class of sizes: whether they may overlap enough, words they must share, and whether pairs meet."""
    share = at_least / (1 + at_least) - 1e-9
    high = F.lit(float([*CLASSES[1:], float("inf")][CLASSES.index(low)] - 1))
    least = F.greatest(F.lit(low), F.ceil(n * at_least - 1e-6))
    shared = F.greatest(F.lit(1), F.ceil((n + least) * share)).cast("int")
    fits = (n >= low * at_least - 1e-6) & (high >= n * at_least - 1e-6)
    return fits, shared, F.lit(low <= SMALL) & (own <= SMALL) & ((own + low) * share > 1)


def _needs_order(n: Column, own: Column, at_least: float, met: Sequence[int]) -> Column:
    """Whether a set's keys leave out some of its words or pairs for any class it meets; if not, their order is nothing to them."""
    rules = [_class_rules(n, own, low, at_least) for low in met]
    return any_of([F.lit(False), *[fits & (shared > F.when(paired, 2).otherwise(1)) for fits, shared, paired in rules]])


def _meeting_keys(rare: Column, at_least: float, first: bool, own: Column | None = None, met: Sequence[int] = CLASSES) -> Column:
    """Keys of a word set, rarest word first, of which two sets with Jaccard overlap of ``at_least`` share one.

    Sets of n and m words overlap by s only if they share o = s / (1 + s) * (n + m)
    words, and then they share k among the first n - o + k and m - o + k rarest.  So
    a set has keys for each class of sizes that the other may have, which are those of
    ``met``: single words, or pairs of words where small sets must share two.  With a
    word that very many sets hold, a set meets only those that have enough else in
    common to be as large.
    """
    n = F.size(rare)
    own = _size_class(n) if own is None else own

    def keys(low: int) -> Column:
        fits, shared, paired = _class_rules(n, own, low, at_least)
        meets = [own, F.lit(low)] if first else [F.lit(low), own]

        def singles() -> Column:
            return F.transform(F.slice(rare, F.lit(1), n - shared + 1), lambda w: F.xxhash64(*meets, w))

        def pairs() -> Column:
            start = F.slice(rare, F.lit(1), n - shared + 2)
            return F.flatten(
                F.transform(
                    start,
                    lambda w, i: F.transform(
                        F.slice(rare, i + 2, n - shared + 1 - i), lambda x: F.xxhash64(*meets, F.least(w, x), F.greatest(w, x))
                    ),
                )
            )

        return F.when(fits & paired, pairs()).when(fits, singles()).otherwise(F.array().cast("array<bigint>"))

    if not met:
        return F.array().cast("array<bigint>")
    return F.array_distinct(F.flatten(F.array(*[keys(low) for low in met])))


def opposed_pairs(canonicals: DataFrame, at_least: float, params: Params = DEFAULT) -> DataFrame:
    """Pairs of canonicals of unlike negation whose words overlap.

    The score is the Jaccard overlap of the words without negators.  Canonicals
    with the same words and the same negation are folded first; the folded rows
    then meet on the keys of ``_meeting_keys``, which lose no pair.  A set looks only
    for classes of sizes that the other side has, and is put in the order of rarity
    only where its keys depend on that: sets of one or two words never are at 0.5.
    """
    words = F.split("norm_text", " ")
    sets = settled(
        canonicals.select("canonical_id", "norm_text"),
        {"words": content_words(words, params), "parity": negation_parity(words, params)},
    ).filter(F.size("words") > 0)
    bag = F.md5(F.concat_ws("|", F.col("parity").cast("string"), F.array_join("words", " ")))
    sets = durable(settled(sets, {"bag": bag}).drop("norm_text"))
    # by number, since keys are much to compute and little to read
    tasks = int(canonicals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bags = sets.repartition(tasks, "bag").groupBy("bag").agg(F.any_value("words").alias("words"), F.any_value("parity").alias("parity"))
    bags = durable(settled(bags, {"own": _size_class(F.size("words"))}))
    classes = {r["parity"]: sorted(r["own"]) for r in bags.groupBy("parity").agg(F.collect_set("own").alias("own")).collect()}
    met = {parity: classes.get(1 - parity, []) for parity in (0, 1)}

    needs = [_needs_order(F.size("words"), F.col("own"), at_least, met[parity]) for parity in (0, 1)]
    needs_order = F.when(F.col("parity") == 0, needs[0]).otherwise(needs[1])
    ready, some = bags.withColumn("rare", F.col("words")), bags.filter(needs_order)
    if not some.isEmpty():
        rarity = bags.select(F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df"))
        order = (
            some.select("bag", F.explode("words").alias("w"))
            .join(rarity, "w")
            .groupBy("bag")
            .agg(F.array_sort(F.collect_list(F.struct("df", "w"))).alias("rare"))
        )
        ranked = some.join(order, "bag").withColumn("rare", F.transform("rare", lambda x: x["w"]))
        ready = durable(ready.filter(~needs_order).unionByName(ranked))

    def spread(mark: str, parity: int) -> DataFrame:
        keys = _meeting_keys(F.col("rare"), at_least, parity == 0, F.col("own"), met[parity])
        side = settled(ready.filter(F.col("parity") == parity), {"keys": keys})
        cols = [F.col(c).alias(f"{mark}_{c}") for c in ("bag", "words", "keys")]
        return side.select(*cols, F.explode("keys").alias("_key"))

    inter, union = F.size(F.array_intersect("l_words", "r_words")), F.size(F.array_union("l_words", "r_words"))
    l_n, r_n = F.size("l_words"), F.size("r_words")
    met = (
        spread("l", 0)
        .join(spread("r", 1), "_key")
        .filter(F.least(l_n, r_n) >= F.greatest(l_n, r_n) * at_least - 1e-9)
        # a pair that shares several keys is checked at one of them
        .filter(F.array_min(F.array_intersect("l_keys", "r_keys")) == F.col("_key"))
        .withColumn("score", F.round(inter / union, 9))
        .filter(F.col("score") >= at_least)
        .select("l_bag", "r_bag", "score")
    )
    members = sets.select("canonical_id", "bag")
    left = members.select(F.col("bag").alias("l_bag"), F.col("canonical_id").alias("x"))
    right = members.select(F.col("bag").alias("r_bag"), F.col("canonical_id").alias("y"))
    return met.join(left, "l_bag").join(right, "r_bag").select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "score"
    )
