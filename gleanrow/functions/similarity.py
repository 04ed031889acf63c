"""Name, room and amenity similarity, and the pair rule built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import haversine
from .options import Options


def indel_ratio(a: str | None, b: str | None) -> float:
    """100 * 2 * LCS / (len(a) + len(b)) of the lower-cased texts; two empty texts: 100."""
    a, b = (a or "").lower(), (b or "").lower()
    if not a and not b:
        return 100.0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    # bit i of row is 0 where the longest common subsequence grows at a[i]
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        match = row & at.get(c, 0)
        row = ((row + match) | (row - match)) & full
    lcs = len(a) - row.bit_count()
    return 200.0 * lcs / (len(a) + len(b))


def _lowered(name: Column) -> Column:
    return F.lower(F.coalesce(name, F.lit("")))


def name_features(name: Column) -> Column:
    """What the filters read, once per row: the length and the distinct pairs of letters, as numbers."""
    x = _lowered(name)
    n = F.length(x)
    letters = F.split(x, "")
    pair = lambda c, d: F.ascii(c).cast("long") * (1 << 21) + F.ascii(d)
    pairs = F.when(n > 1, F.array_distinct(F.zip_with(F.slice(letters, 1, n - 1), F.slice(letters, 2, n - 1), pair)))
    return F.struct(n.alias("n"), F.coalesce(pairs, F.array().cast("array<bigint>")).alias("pairs"))


def least_common(n: Column, m: Column, least: float) -> Column:
    """The longest common subsequence that names of these lengths need for a ratio of least (0 to 100)."""
    return F.ceil(least / 200.0 * (n + m) - 1e-9)


def lost_pairs(n: Column, m: Column, least: float) -> Column:
    """How many pairs of letters of a name of n letters a name of m may lack at a ratio of least.

    Each letter that is not common takes two pairs with it, each letter put between two common ones takes one.
    """
    return 2 * (n - least_common(n, m, least)) + (m - least_common(n, m, least))


def names_may_match(a: Column, b: Column, least: float) -> Column:
    """False only where the ratio of two names is surely below least, by their name_features(): lengths, then pairs."""
    n, m = a["n"], b["n"]
    both = F.size(F.array_intersect(a["pairs"], b["pairs"]))
    asked = F.greatest(F.size(a["pairs"]) - lost_pairs(n, m, least), F.size(b["pairs"]) - lost_pairs(m, n, least))
    return (F.least(n, m) >= least_common(n, m, least)) & ((asked <= 0) | (both >= asked))


#: Bits of a number that a row of the common subsequence uses: two such numbers and a carry fit a long.
LIMB = 62
_FULL = (1 << LIMB) - 1


def letter_masks(name: Column) -> Column:
    """What masked_similarity() reads of its first name, once per row: n, the distinct letters, and where each stands.

    bits[i][k] has bit p set where letter k, counted from 1, is at place LIMB * i + p; letter 0 is any other and nowhere.
    """

    def places(part, letter):
        bits = F.transform(part, lambda c, p: F.when(c == letter, F.call_function("shiftleft", F.lit(1).cast("long"), p)).otherwise(0))
        return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, bit: acc + bit)

    def of(letters):
        each = F.array_distinct(letters)
        limbs = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(letters) / LIMB), F.lit(1)).cast("int") - 1)
        part = lambda i: F.slice(letters, i * LIMB + 1, LIMB)
        bits = F.transform(limbs, lambda i: F.concat(F.array(F.lit(0).cast("long")), F.transform(each, lambda c: places(part(i), c))))
        return F.struct(F.size(letters).alias("n"), each.alias("letters"), bits.alias("bits"))

    return F.transform(F.array(_letters(name)), of)[0]


def _letters(name: Column) -> Column:
    return F.filter(F.split(_lowered(name), ""), lambda c: c != "")


def masked_similarity(a: Column, b: Column) -> Column:
    """indel_ratio() of the name whose letter_masks() are a and the name b, by built-in functions.

    The bit-parallel row of indel_ratio() in numbers of LIMB bits, with the carry handed up from one to the next.
    """
    full, n = F.lit(_FULL), a["n"]
    numbers = F.transform(F.split(_lowered(b), ""), lambda c: F.array_position(a["letters"], c).cast("int"))

    def step(v, m, total):
        return total.bitwiseAND(full).bitwiseOR(v.bitwiseAND(F.bitwise_not(m)))

    def low(v, places):
        """How many of the lowest places are still open."""
        return F.bit_count(v.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.least(places, F.lit(LIMB))) - 1))

    first = a["bits"][0]
    short = F.aggregate(F.transform(numbers, lambda k: F.get(first, k)), full, lambda v, m: step(v, m, v + v.bitwiseAND(m)), lambda v: low(v, n))

    def limb(k):
        def run(acc, vm):
            v, m = vm["v"], F.get(vm["m"], k)
            total = v + v.bitwiseAND(m) + acc["carry"]
            return F.struct(F.shiftright(total, LIMB).alias("carry"), F.concat(acc["row"], F.array(step(v, m, total))).alias("row"))

        return run

    def long(row, k):
        start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("row"))
        both = F.zip_with(row, a["bits"], lambda v, m: F.struct(v.alias("v"), m.alias("m")))
        return F.aggregate(both, start, limb(k), lambda acc: acc["row"])

    rows = F.transform(F.aggregate(numbers, F.array_repeat(full, F.size(a["bits"])), long), lambda v, i: low(v, n - i * LIMB))
    still = F.when(n <= LIMB, short).otherwise(F.aggregate(rows, F.lit(0), lambda acc, x: acc + x))
    total = n + F.length(_lowered(b))
    return F.when(total == 0, 100.0).otherwise(200.0 * (n - still) / total)


def name_similarity(a: Column | str, b: Column | str) -> Column:
    """indel_ratio() of two names; in a join, letter_masks() once per row and masked_similarity() cost less."""
    return masked_similarity(letter_masks(F.col(a) if isinstance(a, str) else a), F.col(b) if isinstance(b, str) else b)


def indel_ratio_sql(a: Column, b: Column) -> Column:
    """The same by built-in functions only (a dynamic programme over arrays); slower, used as a check."""
    x, y = F.lower(F.coalesce(a, F.lit(""))), F.lower(F.coalesce(b, F.lit("")))
    n = F.length(x)
    zero = F.array_repeat(F.lit(0), n + 1)
    letters = F.filter(F.split(y, ""), lambda c: c != "")

    def row(prev, c):
        def cell(acc, i):
            here = F.when(F.substring(x, i, F.lit(1)) == c, F.element_at(prev, i) + 1).otherwise(F.greatest(F.element_at(prev, i + 1),
                F.element_at(acc, -1)))
            return F.concat(acc, F.array(here))

        return F.when(n == 0, prev).otherwise(F.aggregate(F.sequence(F.lit(1), n), F.array(F.lit(0)), cell))

    lcs = F.element_at(F.aggregate(letters, zero, row), -1)
    return F.when((n == 0) & (F.length(y) == 0), 100.0).otherwise(200.0 * lcs / (n + F.length(y)))


def rooms_match(a: str, b: str) -> Column:
    """Rooms of sides a and b (column prefixes): null is a wildcard, at least one pair must be comparable."""
    pairs = [(F.col(f"{a}bedrooms"), F.col(f"{b}bedrooms")), (F.col(f"{a}beds"), F.col(f"{b}beds")),
        (F.col(f"{a}bathrooms"), F.col(f"{b}bathrooms"))]
    some = F.coalesce(*((x == y) for x, y in pairs)).isNotNull()
    equal = F.lit(True)
    for x, y in pairs:
        equal = equal & F.coalesce(x == y, F.lit(True))
    return some & equal


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; an empty or missing side counts as equal."""
    known = (F.coalesce(F.size(a), F.lit(0)) > 0) & (F.coalesce(F.size(b), F.lit(0)) > 0)
    return F.when(known, F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(1.0)


def amenity_list(value: Column) -> Column:
    """The distinct strings of a JSON array; empty if it is none."""
    return F.coalesce(F.array_distinct(F.from_json(value, "array<string>")), F.array().cast("array<string>"))


def distinct_units(a: str, b: str, o: Options = Options()) -> Column:
    """Two rows of one platform that are surely different units: capacities or amenities differ."""
    ga, gb = F.col(f"{a}max_guests"), F.col(f"{b}max_guests")
    capacity = F.coalesce(ga != gb, F.lit(False))
    return (F.col(f"{a}platform") == F.col(f"{b}platform")) & (capacity | (jaccard(F.col(f"{a}amenities"),
        F.col(f"{b}amenities")) < o.amenity_jaccard))


def pair_distance(a: str, b: str) -> Column:
    return haversine(F.col(f"{a}latitude"), F.col(f"{a}longitude"), F.col(f"{b}latitude"), F.col(f"{b}longitude"))


def compatible(row_a: dict, row_b: dict, relaxed: bool, o: Options) -> bool:
    """The pair rule on two plain records, for the clustering kernel."""
    import math

    if row_a["platform"] == row_b["platform"]:
        ga, gb = row_a["max_guests"], row_b["max_guests"]
        if ga is not None and gb is not None and ga != gb:
            return False
        sa, sb = row_a["amenities"], row_b["amenities"]
        if sa and sb and len(sa & sb) / len(sa | sb) < o.amenity_jaccard:
            return False
    p1, p2 = math.radians(row_a["latitude"]), math.radians(row_b["latitude"])
    dp, dl = p2 - p1, math.radians(row_b["longitude"] - row_a["longitude"])
    h = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    metres = 2 * 6_371_000.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h))
    if metres > (o.relaxed_distance_m if relaxed else o.strict_distance_m):
        return False
    name = indel_ratio(row_a["name"], row_b["name"])
    if not relaxed:
        return name >= o.strict_name
    if name >= o.relaxed_name:
        return True
    rooms = [(row_a[k], row_b[k]) for k in ("bedrooms", "beds", "bathrooms") if row_a[k] is not None and row_b[k] is not None]
    return bool(rooms) and all(x == y for x, y in rooms)
