"""Association rules over trip attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citytrace.functions import bins, times, tokens
from citytrace.operators.prepare import prepare_rules
from citytrace.session import cut_lineage

MIN_SUPPORT = 0.001
MIN_CONFIDENCE = 0.25
MIN_LIFT_INTERESTING = 1.05
MIN_CONFIDENCE_INTERESTING = 0.35
SPOTLIGHT = 6

# The categories of the showcase with their predicates over the tokens of a rule.
# "all" are tokens that must be present, "any" groups of which one must be present, "keys" token
# keys that must occur, "not_keys" keys that must not. No relaxed form means strict only.
_GEO = ("source_airport", "destination_airport")
_TRIP = ("distance_bin", "fare_bin")
_CITY = {
    "keys": ("day_type", *_TRIP),
    "not_keys": _GEO,
}
CATEGORIES: dict[str, dict[str, dict]] = {
    "ewr_weekday": {
        "strict": {
            "all": ("destination_airport=EWR", "day_type=Weekday"),
            "keys": ("time_bin", "source_borough", "fare_bin"),
        }
    },
    "ewr_weekend": {
        "strict": {
            "all": ("destination_airport=EWR", "day_type=Weekend"),
            "keys": ("time_bin", "source_borough", "fare_bin"),
        }
    },
    "lga_weekday": {
        "strict": {
            "all": ("destination_airport=LGA", "day_type=Weekday"),
            "keys": ("time_bin", "source_borough", "fare_bin"),
        }
    },
    "lga_weekend": {
        "strict": {
            "all": ("destination_airport=LGA", "day_type=Weekend"),
            "keys": ("time_bin", "source_borough", "fare_bin"),
        }
    },
    "morning_pattern": {
        "strict": {"all": ("time_bin=Morning", "route_type=city_to_city"), **_CITY},
        "relaxed": {"all": ("time_bin=Morning", "route_type=city_to_city"), "keys": _TRIP},
    },
    "night_pattern": {
        "strict": {"all": ("time_bin=Night", "route_type=city_to_city"), **_CITY},
        "relaxed": {"all": ("time_bin=Night", "route_type=city_to_city"), "keys": _TRIP},
    },
    "tipping_pattern": {
        "strict": {"all": ("tip_bin=HighTip",), "keys": ("payment_type", "time_bin", *_TRIP)},
        "relaxed": {"keys": ("tip_bin", "payment_type")},
    },
    "short_high_fare": {
        "strict": {
            "any": (
                ("distance_bin=0-2mi", "distance_bin=2-5mi"),
                ("fare_bin=$80-$100", "fare_bin=$100-$140", "fare_bin=$140-$180"),
            ),
            "keys": ("time_bin",),
        }
    },
    "cash_pattern": {
        "strict": {"all": ("payment_type=Cash",), "keys": ("time_bin", "day_type", "distance_bin")},
        "relaxed": {"all": ("payment_type=Cash",), "keys": ("time_bin",)},
    },
    "credit_pattern": {
        "strict": {"all": ("payment_type=CreditCard",), "keys": ("time_bin", "day_type", "distance_bin")},
        "relaxed": {"all": ("payment_type=CreditCard",), "keys": ("time_bin",)},
    },
}

# Sentence per category; {name} is a token value, {name:lower} its lower case.
CATEGORY_TEXTS = {
    "ewr_weekday": "Weekday {time:lower} trips from {source} to EWR most commonly fall in fare band {fare}.",
    "ewr_weekend": "Weekend {time:lower} demand to EWR is concentrated from {source}, typically within fare band {fare}.",
    "lga_weekday": "Weekday {time:lower} trips from {source} to LGA show a strong fare pattern in {fare}.",
    "lga_weekend": "Weekend {time:lower} LGA travel is dominated by {source} routes with fares around {fare}.",
    "morning_pattern": "Morning demand differs by day type, with {distance} trips most often priced in {fare}.",
    "night_pattern": "Night trips show a distinct weekday/weekend mix, where {distance} rides frequently map to {fare}.",
    "tipping_pattern": "Trips in {distance} and {fare} bands are strongly linked with {tip} tipping behavior.",
    "short_high_fare": "Short-distance rides ({distance}) still show elevated fares ({fare}) during {time:lower} periods.",
    "cash_pattern": "{day} {time:lower} trips in {distance} are more likely to be paid by cash.",
    "credit_pattern": "{day} {time:lower} trips in {distance} are more likely to be paid by credit card.",
}
# What a sentence says where the rule has no such token.
CATEGORY_DEFAULTS = {
    "time": "selected time",
    "day": "all-day",
    "source": "source zones",
    "fare": "selected fare band",
    "distance": "selected distance band",
    "tip": "higher tips",
}
AIRPORT_TEXT = "Airport-linked trips ({movement}) are concentrated around {airport} {window}{on_day}{with_fare}."
FULL_TEXT = "On {day:lower} {time:lower} periods, trips in {distance} most often align with fares in {fare}."
PRICE_TEXT = "{time} travel patterns indicate consistent pricing behavior {for_distance}{and_fare}."
PLAIN_TEXT = (
    "This pattern appears frequently and indicates a stable co-occurrence between "
    "trip context and route characteristics."
)
# Phrase per token key, ahead of the value.
PHRASES = {
    "time_bin": "time of day is {value}",
    "day_type": "it is a {value:lower} trip",
    "source_borough": "pickup is in {value}",
    "destination_borough": "drop-off is in {value}",
    "source_airport": "pickup is from {value} airport",
    "destination_airport": "drop-off is to {value} airport",
    "distance_bin": "distance is in {value}",
    "fare_bin": "fare is in {value}",
    "tip_bin": "tip behavior is {value}",
}
PAYMENT_PHRASES = {"CreditCard": "payment mode is credit card", "Cash": "payment mode is cash"}
NO_RULE_TEXT = "This rule captures a recurring co-occurrence pattern in trips."


def transactions(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Nine ``key=value`` tokens per trip; trips outside every time bucket are left out."""
    trips = prepare_rules(df, zones).withColumn("time_bin", F.initcap(bins.time_bucket(F.col("pickup_hour"))))
    fare = F.col("fare_amount")

    def place(end: str) -> Column:
        airport = F.col(f"{end}_airport")
        return F.coalesce(
            tokens.token(f"{end}_airport", airport), tokens.token(f"{end}_borough", F.col(f"{end}_borough"))
        )

    airports = {
        f"{end}_airport": bins.airport_code(F.col(f"{end}_zone"), F.col(f"{end}_borough"))
        for end in ("source", "destination")
    }
    day = F.when(times.is_weekend(F.col("pickup_date")) == 1, "Weekend").otherwise("Weekday")
    values = {
        "time_bin": F.col("time_bin"),
        "day_type": day,
        "distance_bin": bins.distance_bin(F.col("trip_distance")),
        "fare_bin": bins.fare_bin(fare),
        "tip_bin": bins.tip_bin(F.col("tip_amount"), fare),
        "payment_type": bins.payment_label(F.col("payment_type")),
        "route_type": bins.route_type(F.col("source_airport"), F.col("destination_airport")),
    }
    items = [place("source"), place("destination"), *[tokens.token(k, v) for k, v in values.items()]]
    return trips.where(F.col("time_bin").isNotNull()).withColumns(airports).select(F.array(*items).alias("items"))


#: Tokens of a basket whose subsets are counted, and bits of a set that fit one column.
MAX_ITEMS, WORD = 12, 63


def frequent_sets(baskets: DataFrame, min_support: float) -> tuple[DataFrame, list[str], list[str]]:
    """Sets of items in at least that share of the baskets: (n, words of bits), tokens, word columns.

    Equal baskets are counted first. Each distinct one, cut to its frequent items, gives its subsets
    with that count, so the work follows the number of different baskets, not of trips. A set is a few
    whole numbers, one bit for each frequent token. A basket holds a fixed number of tokens (nine), so
    at most that number divided by the support can be frequent; a basket with more than ``MAX_ITEMS``
    frequent ones raises an error.
    """
    whole = cut_lineage(
        baskets.select(F.array_sort(F.array_distinct("items")).alias("items")).groupBy("items").agg(F.count(F.lit(1)).alias("n"))
    )
    least = whole.agg(F.ceil(F.sum("n") * F.lit(min_support))).scalar()
    single = whole.select(F.explode("items").alias("item"), "n").groupBy("item").agg(F.sum("n").alias("n"))
    known = [row["item"] for row in single.where(F.col("n") >= least).orderBy("item").collect()]
    words = [f"_w{k}" for k in range(len(known) // WORD + 1)]
    place = lambda item: F.array_position(F.lit(known), item).cast("int") - 1
    bits = F.array_compact(F.transform("items", lambda i: F.when(place(i) >= 0, place(i)))) if known else F.array().cast("array<int>")
    size = F.size("_bits")
    checked = F.when(size > MAX_ITEMS, F.raise_error(F.lit("too many items in a basket"))).otherwise(size).cast("int")
    folded = whole.select(bits.alias("_bits"), "n").groupBy("_bits").agg(F.sum("n").alias("n")).where(size > 0)
    masks = folded.withColumn("_m", F.explode(F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), checked) - 1)))

    def word(k: int) -> Column:
        at = [F.get("_bits", F.lit(i)) for i in range(MAX_ITEMS)]
        chosen = [(F.getbit("_m", F.lit(i)) == 1) & (at[i] >= k * WORD) & (at[i] < (k + 1) * WORD) for i in range(MAX_ITEMS)]
        return reduce(
            lambda a, b: a + b,
            [F.when(c, F.call_function("shiftleft", F.lit(1).cast("long"), p - k * WORD)).otherwise(0) for c, p in zip(chosen, at)],
        )

    sets = masks.select(*[word(k).alias(name) for k, name in enumerate(words)], "n")
    return sets.groupBy(*words).agg(F.sum("n").alias("n")).where(F.col("n") >= least), known, words


def mine_rules(
    baskets: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """Rules with one consequent item each, from the frequent sets. Runs Spark jobs."""
    sets, known, words = frequent_sets(baskets, min_support)
    sets = cut_lineage(sets)
    total = baskets.agg(F.count(F.lit(1)).cast("double")).scalar()
    held = lambda place: reduce(
        lambda a, b: a | b,
        [(F.floor(place / WORD) == k) & (F.getbit(name, (place % WORD).cast("int")) == 1) for k, name in enumerate(words)],
    )
    places = F.filter(F.sequence(F.lit(0), F.lit(max(0, len(known) - 1))), held)
    listed = sets.withColumn("_places", places)
    split = listed.where(F.size("_places") > 1).select("*", F.explode("_places").alias("_of"))
    without = [
        F.when(F.floor(F.col("_of") / WORD) == k, F.col(name) - F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_of") % WORD))
        .otherwise(F.col(name))
        .alias(name)
        for k, name in enumerate(words)
    ]
    split = split.select(*without, F.array_remove("_places", F.col("_of")).alias("_left"), "_of", F.col("n").alias("n_both"))
    left = sets.withColumnRenamed("n", "n_left")
    right = listed.where(F.size("_places") == 1).select(F.col("_places")[0].alias("_of"), F.col("n").alias("n_right"))
    confidence = F.col("n_both").cast("double") / F.col("n_left")
    named = lambda place: F.get(F.lit(known) if known else F.array().cast("array<string>"), place)
    return (
        split.join(left, words)
        .where(confidence >= min_confidence)
        .join(right, "_of")
        .select(
            F.transform("_left", named).alias("antecedent"),
            F.array(named(F.col("_of"))).alias("consequent"),
            (F.col("n_both") / total).alias("support"),
            confidence.alias("confidence"),
            (confidence / (F.col("n_right") / total)).alias("lift"),
        )
    )


def _all_tokens() -> Column:
    return F.concat(F.array_sort("antecedent"), F.array_sort("consequent"))


def rule_text(rules: DataFrame) -> DataFrame:
    return rules.withColumn("rule", tokens.rule_text(F.col("antecedent"), F.col("consequent")))


def _airport(items: Column) -> Column:
    return tokens.has_key(items, "source_airport") | tokens.has_key(items, "destination_airport")


def _priced(items: Column) -> Column:
    return tokens.has_key(items, "distance_bin") & tokens.has_key(items, "fare_bin")


def interesting(rules: DataFrame) -> DataFrame:
    """Flag of rules that tell time together with an airport or a distance and a fare. Never a filter."""
    items = _all_tokens()
    flag = (
        tokens.has_key(items, "time_bin")
        & (_airport(items) | _priced(items))
        & (F.col("lift") >= MIN_LIFT_INTERESTING)
        & (F.col("confidence") >= MIN_CONFIDENCE_INTERESTING)
    )
    return rules.withColumn("interesting_flag", flag)


def rank_rules(rules: DataFrame) -> DataFrame:
    """Ranking score: confidence * lift with bonuses for airport, day, priced distance and support."""
    items = _all_tokens()
    bonus = lambda wins, factor: F.when(wins, F.lit(factor)).otherwise(F.lit(1.0))
    score = (
        F.col("confidence")
        * F.col("lift")
        * bonus(_airport(items), 1.35)
        * bonus(tokens.has_key(items, "day_type"), 1.10)
        * bonus(_priced(items), 1.20)
        * (F.least(F.col("support"), F.lit(0.2)) + 1.0)
    )
    return rules.withColumn("ranking_score", score)


def _fill(template: str, parts: dict[str, Column]) -> Column:
    """A template as one concatenation; NULL when a part it names is NULL."""
    pieces: list[Column] = []
    for chunk in template.replace("}", "{").split("{"):
        name, _, style = chunk.partition(":")
        if name in parts:
            pieces.append(F.lower(parts[name]) if style == "lower" else parts[name])
        elif chunk:
            pieces.append(F.lit(chunk))
    return F.concat(*pieces)


def insight(rules: DataFrame) -> DataFrame:
    """A sentence about every rule, from the most telling template its tokens can fill."""
    items = _all_tokens()
    of = lambda key: tokens.token_value(items, key)
    time, fare, distance = of("time_bin"), of("fare_bin"), of("distance_bin")
    optional = lambda text: F.coalesce(text, F.lit(""))
    parts = {
        "time": time,
        "day": of("day_type"),
        "distance": distance,
        "fare": fare,
        "movement": F.replace(of("route_type"), F.lit("_"), F.lit(" ")),
        "airport": F.coalesce(of("source_airport"), of("destination_airport")),
        "window": F.coalesce(F.concat(F.lit("during "), F.lower(time)), F.lit("across time windows")),
        "on_day": optional(F.concat(F.lit(" on "), F.lower(of("day_type")), F.lit("s"))),
        "with_fare": optional(F.concat(F.lit(" with fares commonly in "), fare)),
        "for_distance": F.coalesce(F.concat(F.lit("for "), distance, F.lit(" trips")), F.lit("for these trips")),
        "and_fare": optional(F.concat(F.lit(" and fares in "), fare)),
    }
    priced = F.when(distance.isNotNull() | fare.isNotNull(), _fill(PRICE_TEXT, parts))
    return rules.withColumn(
        "insight", F.coalesce(_fill(AIRPORT_TEXT, parts), _fill(FULL_TEXT, parts), priced, F.lit(PLAIN_TEXT))
    )


def category_insight(category: Column, items: Column) -> Column:
    """Sentence of a showcase category filled with the tokens of the chosen rule."""
    of = lambda key: tokens.token_value(items, key)
    found = {
        "time": of("time_bin"),
        "day": of("day_type"),
        "source": F.coalesce(of("source_borough"), of("source_airport")),
        "fare": of("fare_bin"),
        "distance": of("distance_bin"),
        "tip": of("tip_bin"),
    }
    parts = {name: F.coalesce(value, F.lit(CATEGORY_DEFAULTS[name])) for name, value in found.items()}
    return F.coalesce(*[F.when(category == name, _fill(text, parts)) for name, text in CATEGORY_TEXTS.items()])


def token_phrase(tok: Column) -> Column:
    """A token in words."""
    key, value = F.split(tok, "=", 2)[0], tokens.value_of(tok)
    spoken = [F.when(key == k, _fill(text, {"value": value})) for k, text in PHRASES.items()]
    paid = F.coalesce(
        *[F.when(value == v, F.lit(text)) for v, text in PAYMENT_PHRASES.items()],
        F.concat(F.lit("payment mode is "), F.lower(value)),
    )
    plain = lambda text: F.replace(text, F.lit("_"), F.lit(" "))
    return F.coalesce(
        *spoken,
        F.when(key == "payment_type", paid),
        F.when(key == "route_type", F.concat(F.lit("route type is "), plain(value))),
        plain(tok),
    )


def join_phrases(phrases: Column) -> Column:
    """Phrases as a list in English."""
    n = F.size(phrases)
    many = F.concat(F.array_join(F.slice(phrases, 1, F.greatest(n - 1, F.lit(1))), ", "), F.lit(", and "))
    last = F.try_element_at(phrases, F.lit(-1))
    return F.when(n <= 2, F.array_join(phrases, " and ")).otherwise(F.concat(many, last))


def rule_sentence(rules: DataFrame) -> DataFrame:
    """A sentence read back from the rule text, with its confidence where there is one."""
    spoken = lambda side: join_phrases(F.transform(F.col(f"_parsed.{side}"), token_phrase))
    left, right = spoken("antecedent"), spoken("consequent")
    share = F.format_string("%.1f%%", F.rint(F.col("confidence") * 1000.0) / 10.0)
    sure = F.col("confidence").isNotNull() & ~F.isnan("confidence")
    both = (left != "") & (right != "")
    text = (
        F.when((left == "") & (right == ""), F.lit(NO_RULE_TEXT))
        .when(both & sure, F.concat(F.lit("When "), left, F.lit(", "), right, F.lit(" is seen in about "), share, F.lit(" of such trips.")))
        .when(both, F.concat(F.lit("When "), left, F.lit(", it is likely that "), right, F.lit(".")))
        .when((right != "") & sure, F.concat(F.lit("This pattern indicates "), right, F.lit(" in about "), share, F.lit(" of matching trips.")))
        .when(right != "", F.concat(F.lit("This pattern indicates "), right, F.lit(".")))
        .otherwise(F.concat(F.lit("This pattern is associated with "), left, F.lit(".")))
    )
    return (
        rules.withColumn("_parsed", tokens.parse_rule(F.col("rule")))
        .withColumn("sentence", text)
        .drop("_parsed")
    )


def _matches(items: Column, form: dict) -> Column:
    terms = [F.array_contains(items, t) for t in form.get("all", ())]
    terms += [F.arrays_overlap(items, F.lit(list(group))) for group in form.get("any", ())]
    terms += [tokens.has_key(items, k) for k in form.get("keys", ())]
    terms += [~tokens.has_key(items, k) for k in form.get("not_keys", ())]
    return reduce(lambda a, b: a & b, terms)


def categorise(rules: DataFrame) -> DataFrame:
    """One row per rule, category and form (strict or relaxed) the rule belongs to."""
    items = _all_tokens()
    entries = [
        F.when(
            _matches(items, form),
            F.struct(F.lit(place).alias("place"), F.lit(name).alias("category"), F.lit(kind).alias("match_kind")),
        )
        for place, (name, forms) in enumerate(CATEGORIES.items())
        for kind, form in forms.items()
    ]
    member = F.explode(F.array_compact(F.array(*entries)))
    return rules.withColumn("_m", member).select(*rules.columns, "_m.place", "_m.category", "_m.match_kind")


def showcase(ranked: DataFrame) -> DataFrame:
    """The best rule of every category that no earlier category took; strict before relaxed.

    A category without a match keeps NULL statistics and ``match_kind = 'none'``. Each pick can
    use up one rule, so the ten best of every category and form decide the result: at most 150
    candidates meet in one row and the ten picks are column expressions over them.
    """
    top = len(CATEGORIES)
    order = [F.desc("ranking_score"), F.desc("lift"), F.desc("confidence"), F.desc("support"), F.asc("rule")]
    turn = F.row_number().over(Window.partitionBy("category", "match_kind").orderBy(*order))
    rows = categorise(ranked).withColumn("_turn", turn).where(F.col("_turn") <= top)
    fields = F.struct("_turn", "category", "match_kind", "rule", "support", "confidence", "lift", _all_tokens().alias("items"))
    state = rows.agg(F.sort_array(F.collect_list(fields)).alias("_all"))
    picks: list[str] = []
    for place, name in enumerate(CATEGORIES):
        used = F.array_compact(F.array(*[F.col(p)["rule"] for p in picks])) if picks else F.array().cast("array<string>")
        first = lambda kind: F.try_element_at(
            F.filter(
                F.col("_all"),
                lambda r: (r["category"] == name) & (r["match_kind"] == kind) & ~F.array_contains(F.col("_used"), r["rule"]),
            ),
            F.lit(1),
        )
        picks.append(f"_pick{place}")
        state = state.withColumn("_used", used).withColumn(picks[-1], F.coalesce(first("strict"), first("relaxed")))
    chosen = F.array(
        *[
            F.struct(F.lit(i).alias("place"), F.lit(name).alias("category"), F.col(picks[i]).alias("r"))
            for i, name in enumerate(CATEGORIES)
        ]
    )
    listed = state.select(F.explode(chosen).alias("c")).select("c.place", "c.category", "c.r")
    return listed.select(
        "place",
        "category",
        F.coalesce("r.match_kind", F.lit("none")).alias("match_kind"),
        "r.rule",
        "r.support",
        "r.confidence",
        "r.lift",
        F.when(F.col("r").isNotNull(), category_insight(F.col("category"), F.col("r.items"))).alias("insight"),
    )


def all_rules(rules: DataFrame) -> DataFrame:
    """Published list: strongest lift first, rule text on ties."""
    listed = insight(rule_text(rules)).select("rule", "support", "confidence", "lift", "insight")
    return listed.orderBy(F.desc("lift"), F.desc("confidence"), F.desc("support"), "rule")


def airport_spotlight(rules: DataFrame, k: int = SPOTLIGHT) -> DataFrame:
    """Strongest listed rules that mention an airport in rule or sentence."""
    mentions = F.coalesce(F.col("rule").ilike("%airport%"), F.lit(False)) | F.coalesce(
        F.col("insight").ilike("%airport%"), F.lit(False)
    )
    return rules.where(mentions).orderBy(F.desc("lift"), F.desc("confidence"), F.desc("support"), "rule").limit(k)


def rule_kpis(baskets: DataFrame, rules: DataFrame, top: DataFrame) -> DataFrame:
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    zero = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return top.agg(zero("confidence").alias("avg_confidence"), zero("lift").alias("avg_lift")).select(
        count(baskets).alias("total_transactions"), count(rules).alias("total_rules"), "*"
    )
