"""Resolving raw names to cities: exact, then fuzzy, then quarantine.

Each distinct name is judged once against the state at the start of the batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, lookup_key, sort_tokens
from ..schemas import QUARANTINE
from ..session import WAVES
from .barrier import computed_once
from .dimension import active
from .numbering import highest, number_rows

# The lowest accepted similarity, and the origin written to the quarantine.
CUTOFF = 90
QUARANTINE_SOURCE = "pipeline"

# Names up to this length are matched through their shortened forms: 137 at most.
ENUMERATED_LENGTH = 16

# Spark takes a table of keys, forms or pieces of names, and what is found by them, for as small as the file
# of cities, and would send it to the driver.
UNDERRATED = "merge"


@dataclass(frozen=True)
class Resolution:
    """``names``: every distinct raw name with ``occurrences``, ``city_id``, ``match_method``
    and, for fuzzy matches, ``score``; ``new_aliases`` and ``unmatched`` feed the merges."""

    names: DataFrame
    new_aliases: DataFrame
    unmatched: DataFrame


def resolve_names(
    raw: DataFrame, dim_city: DataFrame, aliases: DataFrame, stage: Callable[[DataFrame, str], DataFrame] | None = None
) -> Resolution:
    """Resolve the column ``raw_name``.

    Blank names resolve to nothing and are not quarantined. If one spelling of a
    name matches fuzzily, all spellings with the same lookup key resolve with it,
    and the smallest matching spelling becomes the alias.

    With ``stage``, which stores a frame and gives it back, names are counted and matched once,
    however many of the results are used.
    """
    stage = stage or (lambda df, label: df)
    distinct = raw.groupBy("raw_name").agg(F.count(F.lit(1)).alias("occurrences"))
    # Filters on names and keys would move below the count, make every row's name again there, and keep
    # the branches below from sharing one count.
    keyed = stage(
        computed_once(distinct.withColumn("key", F.when(~is_blank(F.col("raw_name")), lookup_key(F.col("raw_name"))))),
        "counted_names",
    )
    exact = keyed.join(lookup_table(dim_city, aliases).hint(UNDERRATED), "key", "left")
    missed = exact.filter(F.col("key").isNotNull() & F.col("city_id").isNull())
    matched = best_matches(missed.select("raw_name"), active(dim_city))
    per_key = stage(
        matched.withColumn("key", lookup_key(F.col("raw_name")))
        .groupBy("key")
        .agg(F.min(F.struct("raw_name", "city_id", "score")).alias("_first"))
        .select("key", F.col("_first.city_id").alias("fuzzy_id"), F.col("_first.score").alias("score"),
                F.col("_first.raw_name").alias("raw_alias")),
        "matched_keys",
    )
    joined = exact.join(per_key.hint(UNDERRATED), "key", "left")
    names = joined.select(
        "raw_name",
        "occurrences",
        F.coalesce("city_id", "fuzzy_id").alias("city_id"),
        F.when(F.col("city_id").isNotNull(), "exact").when(F.col("fuzzy_id").isNotNull(), "fuzzy").alias("match_method"),
        F.when(F.col("city_id").isNull(), F.col("score")).alias("score"),
    )
    return Resolution(
        names=names,
        new_aliases=per_key.select(
            "raw_alias", F.col("fuzzy_id").alias("canonical_city_id"), F.lit("fuzzy").alias("match_method")
        ),
        unmatched=names.filter(F.col("city_id").isNull() & ~is_blank(F.col("raw_name"))).select(
            "raw_name", "occurrences"
        ),
    )


def lookup_table(dim_city: DataFrame, aliases: DataFrame) -> DataFrame:
    """(key, city_id) for exact lookups.

    Aliases count whatever their city's activity; names of active cities take
    precedence over them. The lowest number wins among equals.
    """
    entries = active(dim_city).select(
        lookup_key(F.col("city_name")).alias("key"), F.lit(0).alias("rank"), F.col("city_id")
    ).unionByName(
        aliases.select(
            lookup_key(F.col("raw_alias")).alias("key"), F.lit(1).alias("rank"), F.col("canonical_city_id").alias("city_id")
        )
    )
    best = entries.groupBy("key").agg(F.min(F.struct("rank", "city_id")).alias("_best"))
    return best.select("key", F.col("_best.city_id").alias("city_id"))


def best_matches(names: DataFrame, cities: DataFrame, cutoff: int = CUTOFF) -> DataFrame:
    """(raw_name, city_id, score): the most similar city of each ``raw_name``, if similar enough.

    Similarity is 100 * 2 * c / (a + b) for the lengths a, b of the two names
    with sorted tokens and the length c of their longest common subsequence.
    Upper and lower case differ. The lowest city number wins among equals.

    Short names share a shortened form, and all cities with that form are
    reduced to their best before the join, so the join never multiplies rows.
    Longer names meet an equal city, or one that is a single edit away; only names that have neither
    are compared with all cities of fitting length, by signatures first.
    """
    # A name is small and multiplies into many forms: a fixed number of partitions
    # keeps small inputs from being coalesced into one task before that.
    partitions = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Both sides are read in several places, each with filters of its own, which shall not move below the shuffles.
    tokens = computed_once(names.select("raw_name", sort_tokens(F.col("raw_name")).alias("text")))
    probes = computed_once(tokens.select("text").repartition(partitions, "text").distinct())
    named = cities.select(sort_tokens(F.col("city_name")).alias("text"), "city_id").repartition(partitions, "text")
    candidates = computed_once(named.groupBy("text").agg(F.min("city_id").alias("city_id")))
    found = _short_matches(probes, candidates, cutoff).unionByName(_long_matches(probes, candidates, cutoff))
    best = found.groupBy("text").agg(F.max(F.struct("score", (-F.col("city_id")).alias("minus_id"))).alias("_best"))
    return tokens.join(best.hint(UNDERRATED), "text").select(
        "raw_name", (-F.col("_best.minus_id")).alias("city_id"), F.col("_best.score").alias("score")
    )


def similarity(common: Column, left: Column, right: Column) -> Column:
    return F.lit(200.0) * common / (left + right)


def _close_enough(common: Column, left: Column, right: Column, cutoff: int) -> Column:
    return common * 200 >= (left + right) * cutoff


def _lengths(df: DataFrame, name: str) -> DataFrame:
    """As many rows as there are lengths."""
    return df.select(F.length("text").alias(name)).distinct()


def _most_deletions(length: int, cutoff: int) -> int:
    """How many characters a name may lose if the other name is all that is left of it."""
    return length * (200 - 2 * cutoff) // (200 - cutoff)


def _shortened(df: DataFrame, others: DataFrame, cutoff: int) -> DataFrame:
    """Every form of ``text`` with a few characters deleted, itself included, as ``form``.

    Deletions go from left to right, so that no set of positions comes twice. No more are deleted
    than the lengths of ``others`` allow: what is left must be close enough to one that is at least as long.
    """
    a, b = F.col("_own"), F.col("_other")
    spare = a * (200 - cutoff) - b * cutoff
    allowed = F.call_function("div", spare, F.lit(200)).cast("int")
    own, other = (_lengths(x, n).filter(F.col(n) <= ENUMERATED_LENGTH) for x, n in ((df, "_own"), (others, "_other")))
    usable = own.crossJoin(other).filter((spare >= 0) & (a - b <= allowed)).groupBy("_own").agg(F.max(allowed).alias("_most"))

    def without_one_more(cuts: Column) -> Column:
        def drop(cut: Column) -> Column:
            form, start = cut["form"], cut["start"]
            positions = F.when(start <= F.length(form), F.sequence(start, F.length(form))).otherwise(
                F.array().cast("array<int>")
            )
            return F.transform(
                positions,
                lambda i: F.struct(
                    F.concat(F.left(form, i - 1), F.substr(form, i + 1)).alias("form"), i.alias("start")
                ),
            )

        return F.flatten(F.transform(cuts, drop))

    levels = [F.array(F.struct(F.col("text").alias("form"), F.lit(1).alias("start")))]
    for deleted in range(1, _most_deletions(ENUMERATED_LENGTH, cutoff) + 1):
        levels.append(F.when(F.col("_most") >= deleted, without_one_more(levels[-1])).otherwise(F.array_remove(levels[0], levels[0][0])))
    cuts = F.explode(F.concat(*levels)).alias("cut")
    # At most one row for each length up to the limit.
    fitting = df.join(F.broadcast(usable), F.length("text") == a)
    return fitting.select(*df.columns, cuts).select(*df.columns, "cut.form")


def _short_matches(probes: DataFrame, candidates: DataFrame, cutoff: int) -> DataFrame:
    """Two strings have a common subsequence of length c exactly if deleting
    characters down to c can make them equal. For one form the best city is the
    one with the shortest name."""
    per_form = (
        _shortened(candidates, probes, cutoff)
        .groupBy("form")
        .agg(F.min(F.struct(F.length("text").alias("length"), "city_id")).alias("_best"))
    )
    common, left, right = F.length("form"), F.length("text"), F.col("_best.length")
    return (
        _shortened(probes, candidates, cutoff)
        .join(per_form.hint(UNDERRATED), "form")
        .filter(_close_enough(common, left, right, cutoff))
        .select("text", F.col("_best.city_id").alias("city_id"), similarity(common, left, right).alias("score"))
    )


#: Windows of a name in which a single edit is sought, and parts into which the cities of one length are dealt.
WINDOWS, PARTS = 4, 8

#: Numbers of 64 bits that hold the two signatures of a name: of its characters, and of its pairs of characters.
SINGLES, PAIRS = 4, 8


def _long_matches(probes: DataFrame, candidates: DataFrame, cutoff: int) -> DataFrame:
    """Pairs in which at least one name is too long to enumerate, as far as they can be the best of their name.

    An equal city is the best one there is, and otherwise one at a single insertion or deletion: two edits
    cost more, whatever the lengths are. So a name that has either is done, and only the rest is compared with all
    cities of fitting length.
    """
    shortest = -(-(ENUMERATED_LENGTH + 1) * cutoff // (200 - cutoff))
    names, cities = (df.filter(F.length("text") >= shortest) for df in (probes, candidates))
    equal = names.filter(F.length("text") > ENUMERATED_LENGTH).join(cities.hint(UNDERRATED), "text")
    # The score of equal texts does not depend on their length.
    near = equal.select("text", "city_id", F.lit(100.0).alias("score")).unionByName(_one_edit(names, cities, cutoff))
    best = near.groupBy("text").agg(F.max(F.struct("score", (-F.col("city_id")).alias("minus_id"))).alias("_near"))
    # Fixed here, so that both uses share it.
    judged = computed_once(names.join(best.hint(UNDERRATED), "text", "left").select("text", "_near.minus_id", "_near.score"))
    done = judged.filter(F.col("score").isNotNull()).select("text", (-F.col("minus_id")).alias("city_id"), "score")
    return done.unionByName(_any_edits(judged.filter(F.col("score").isNull()).select("text"), cities, cutoff))


def _one_edit(names: DataFrame, cities: DataFrame, cutoff: int) -> DataFrame:
    """Pairs that differ by one character too many on either side.

    The longer text, of n characters, is cut into windows. One of them holds the character that the shorter text lacks,
    and what is before and after it is equal. So pairs meet on all of a text but a window,
    which a word that many names share does not make equal.
    """

    def without_window(df: DataFrame, longer: Column) -> DataFrame:
        n, window = F.col("n"), F.col("window")
        start = F.call_function("div", window * n, F.lit(WINDOWS)).cast("int")
        after = (n - F.call_function("div", (window + 1) * n, F.lit(WINDOWS))).cast("int")
        return (
            df.withColumn("of_city", F.explode(F.array(F.lit(True), F.lit(False))))
            .withColumn("n", F.length("text") + F.when(longer, 0).otherwise(1))
            .filter(n > ENUMERATED_LENGTH)
            .withColumn("window", F.explode(F.sequence(F.lit(0), F.lit(WINDOWS - 1))))
            .withColumn("stretch", F.xxhash64("n", "of_city", "window", F.left("text", start), F.right("text", after)))
            .drop("n", "of_city", "window")
        )

    indexed = without_window(cities, F.col("of_city")).withColumnRenamed("text", "city_text")
    left, right = F.length("text"), F.length("city_text")
    edited = F.call_function("levenshtein", F.col("text"), F.col("city_text"), F.lit(1)) == 1
    pairs = without_window(names, ~F.col("of_city")).join(indexed.hint(UNDERRATED), "stretch")
    common = F.least(left, right)
    return pairs.filter((F.abs(left - right) == 1) & _close_enough(common, left, right, cutoff) & edited).select(
        "text", "city_id", similarity(common, left, right).alias("score")
    )


def _signed(df: DataFrame) -> DataFrame:
    """Add two signatures of ``text``, as numbers ``s0``, ``s1`` and so on.

    The first is made of its characters, each with the number of equal ones before it, the second of its pairs of
    neighbours, with the last character alone. A bit says whether the number of those hashed to it is odd. An insertion
    or deletion adds or takes one of the first kind and three of the second at most, so texts at d
    of them differ by d and 3 d bits at most.
    """
    at, text = F.col("_at"), F.col("text")
    char, before = F.substr(text, at, F.lit(1)), F.left(text, at - 1)
    equal = F.length(before) - F.length(F.replace(before, char, F.lit("")))
    spots = df.withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("text")))).select(
        *df.columns,
        F.pmod(F.xxhash64(char, equal), F.lit(64 * SINGLES)).cast("int").alias("_single"),
        F.pmod(F.xxhash64(F.substr(text, at, F.lit(2))), F.lit(64 * PAIRS)).cast("int").alias("_pair"),
    )
    zero = F.lit(0).cast("bigint")

    def word(spot: Column, k: int) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), spot.bitwiseAND(63))
        return F.coalesce(F.bit_xor(F.when(F.shiftright(spot, 6) == k, bit).otherwise(zero)), zero)

    words = [word(F.col("_single"), k) for k in range(SINGLES)] + [word(F.col("_pair"), k) for k in range(PAIRS)]
    return spots.groupBy(*df.columns).agg(*[w.alias(f"s{k}") for k, w in enumerate(words)])


def _bits_apart(words: range) -> Column:
    return reduce(add, [F.bit_count(F.col(f"s{k}").bitwiseXOR(F.col(f"t{k}"))) for k in words])


def _any_edits(names: DataFrame, cities: DataFrame, cutoff: int) -> DataFrame:
    """All pairs that are close enough.

    Names meet all cities of a fitting length, and signatures drop nearly all pairs inside the join. That compares more
    pairs than equal pieces would let meet, but by a few instructions each, and a word that all
    names share costs nothing: neither a name nor a city becomes more than a few rows for each fitting length.
    """
    conf = names.sparkSession
    partitions = max(int(conf.conf.get("spark.sql.shuffle.partitions")), WAVES * conf.sparkContext.defaultParallelism)
    length = F.length("text")
    low = F.ceil(length * cutoff / F.lit(200.0 - cutoff)).cast("int")
    high = F.floor(length * (200 - cutoff) / F.lit(float(cutoff))).cast("int")
    sought = (
        _signed(names)
        .withColumn("a", F.coalesce(length, F.lit(0)))
        .withColumn("b", F.explode(F.sequence(low, high)))
        .join(_lengths(cities, "b"), "b", "left_semi")
        .filter(F.greatest("a", "b") > ENUMERATED_LENGTH)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    )
    dealt = _signed(cities).select(
        F.coalesce(length, F.lit(0)).alias("b"), F.pmod(F.xxhash64("text"), F.lit(PARTS)).cast("int").alias("part"),
        F.col("text").alias("city_text"), "city_id", *[F.col(f"s{k}").alias(f"t{k}") for k in range(SINGLES + PAIRS)],
    )
    # Few bytes, many pairs: a fixed number of partitions keeps them from being coalesced.
    sought, dealt = (df.repartition(partitions, "b", "part") for df in (sought, dealt))
    met = sought.join(dealt.hint(UNDERRATED), ["b", "part"])
    edits = (F.col("a") + F.col("b")) * (100 - cutoff)
    # Each pair costs what the join reads of it, so that is the shorter signature only. The longer one is one number
    # before it is judged: the optimizer's time doubles with each column that a filter above a barrier reads.
    alike = met.filter(_bits_apart(range(SINGLES)) * 100 <= edits)
    pieces = (_bits_apart(range(SINGLES, SINGLES + PAIRS)) * 100 <= edits * 3).alias("_pieces")
    pairs = computed_once(alike.select("text", "city_text", "city_id", pieces)).filter("_pieces").drop("_pieces")
    left, right = F.length("text"), F.length("city_text")
    # Insertions and deletions alone are at least as many as with replacements, which the banded distance counts fast.
    most = F.call_function("div", (left + right) * (100 - cutoff), F.lit(100)).cast("int")
    near = computed_once(pairs.filter(F.call_function("levenshtein", F.col("text"), F.col("city_text"), most) >= 0))
    verified = with_common_length(near, "text", "city_text")
    return verified.filter(_close_enough(F.col("common"), left, right, cutoff)).select(
        "text", "city_id", similarity(F.col("common"), left, right).alias("score")
    )


#: Bits of a limb, so that the sum of two limbs and a carry stays a positive long.
LIMB = 62


def with_common_length(pairs: DataFrame, left: str, right: str, name: str = "common") -> DataFrame:
    """Add the length of the longest common subsequence of two texts, by bit-parallel counting.

    A row of the comparison is a number with one bit per character of ``left``, kept in
    limbs of 62 bits. Each character of ``right`` changes the row by one addition, whose carries
    run from limb to limb, and two bit operations; the bits that have become 0 count the
    common characters. Rows need as many steps as ``right`` has characters, not as both multiplied.
    """
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    a, b, columns = F.col(left), F.col(right), pairs.columns

    def characters(text: Column) -> Column:
        places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.substr(text, i, F.lit(1)))

    def mask(char: Column, chunk: Column) -> Column:
        """Bits of the places at which a chunk of characters has ``char``."""
        places = F.transform(chunk, lambda c, i: F.when(c == char, F.call_function("shiftleft", one, i)).otherwise(zero))
        return F.aggregate(places, zero, lambda x, y: x + y)

    # What the steps look up is computed before them: within a lambda it would be computed at each step.
    limbs = F.greatest(F.lit(1), F.ceil(F.length(a) / F.lit(float(LIMB))).cast("int"))
    chunks = F.transform(F.sequence(F.lit(0), limbs - 1), lambda k: F.slice("_chars", k * LIMB + 1, LIMB))
    ready = computed_once(pairs.withColumn("_chars", characters(a)))
    ready = computed_once(ready.withColumn("_chunks", chunks))
    ready = computed_once(
        ready.select(
            *columns,
            characters(b).alias("_others"),
            F.map_from_entries(
                F.transform(F.array_distinct("_chars"), lambda c: F.struct(c, F.transform("_chunks", lambda chunk: mask(c, chunk))))
            ).alias("_masks"),
            F.transform("_chunks", lambda chunk: F.call_function("shiftleft", one, F.size(chunk)) - 1).alias("_ones"),
        )
    )

    def step(row: Column, char: Column) -> Column:
        found = F.try_element_at(F.col("_masks"), char)

        def limb(state: Column, part: Column) -> Column:
            kept = part["row"].bitwiseAND(part["hit"])
            total = part["row"] + kept + state["carry"]
            changed = total.bitwiseOR(part["row"] - kept).bitwiseAND(part["ones"])
            return F.struct(F.concat(state["row"], F.array(changed)).alias("row"), F.shiftright(total, LIMB).alias("carry"))

        start = F.struct(F.array().cast("array<bigint>").alias("row"), zero.alias("carry"))
        parts = F.arrays_zip(row.alias("row"), found.alias("hit"), F.col("_ones").alias("ones"))
        # A character that the left text lacks changes nothing.
        return F.when(found.isNull(), row).otherwise(F.aggregate(parts, start, limb)["row"])

    short = F.size("_ones") == 1

    def short_step(row: Column, char: Column) -> Column:
        kept = row.bitwiseAND(F.coalesce(F.try_element_at(F.col("_masks"), char)[0], zero))
        return (row + kept).bitwiseOR(row - kept).bitwiseAND(F.col("_ones")[0])

    def ones_left(limb: Column) -> Column:
        return F.bit_count(limb)

    brief = ones_left(F.aggregate("_others", F.col("_ones")[0], short_step))
    several = F.aggregate(F.aggregate("_others", F.col("_ones"), step), F.lit(0), lambda n, limb: n + ones_left(limb))
    return ready.select(*columns, (F.length(a) - F.when(short, brief).otherwise(several)).alias(name))


def merge_quarantine(old: DataFrame, unmatched: DataFrame, now: Column | None = None) -> DataFrame:
    """Count unmatched names: new ones start with their occurrences, known ones add them.

    Known names keep number, ``first_seen_at`` and ``resolved``.
    """
    now = F.current_timestamp() if now is None else now
    joined = old.join(unmatched, "raw_name", "full_outer")
    known, seen = F.col("id").isNotNull(), F.col("occurrences").isNotNull()
    merged = joined.select(
        "id",
        "raw_name",
        F.coalesce("source", F.lit(QUARANTINE_SOURCE)).alias("source"),
        F.coalesce("first_seen_at", now).alias("first_seen_at"),
        F.when(seen, now).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        (F.coalesce("occurrence_count", F.lit(0)) + F.coalesce("occurrences", F.lit(0))).alias("occurrence_count"),
        F.coalesce("resolved", F.lit(False)).alias("resolved"),
    )
    fresh = number_rows(merged.filter(~known).drop("id"), "id", ["raw_name"], highest(old, "id"))
    both = merged.filter(known).unionByName(fresh)
    return both.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in QUARANTINE])
