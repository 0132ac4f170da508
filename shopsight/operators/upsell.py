"""Category opportunity, co-purchase affinity and per-user recommendations.

Most functions read *demand*: rows with user_id, category and the additive measures `views`
and `purchases`. `as_demand` makes one such row per event; `user_demand` adds them up to one
row per user and category, the form to write once when several steps share it.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from shopsight.config import UpsellConfig
from shopsight.functions.events import UNKNOWN, is_type
from shopsight.functions.numbers import ratio
from shopsight.operators.features import category_stats
from shopsight.sources.tables import materialise

MASK_BITS = 62


def as_demand(events: DataFrame, include_unknown: bool = False) -> DataFrame:
    """Events with a `category` column (functions.events.with_category) as demand rows."""
    known = events if include_unknown else events.filter(F.col("category") != UNKNOWN)
    return known.select(
        "user_id",
        "category",
        is_type("view").cast("long").alias("views"),
        is_type("purchase").cast("long").alias("purchases"),
    )


def user_demand(demand: DataFrame) -> DataFrame:
    return demand.groupBy("user_id", "category").agg(
        F.sum("views").alias("views"), F.sum("purchases").alias("purchases")
    )


def _gap(alpha: float, views: str = "views", purchases: str = "purchases") -> Column:
    """Unmet demand: views not explained by alpha views per purchase."""
    return F.greatest(F.col(views) - F.col(purchases) * F.lit(float(alpha)), F.lit(0.0))


def _per_category(demand: DataFrame) -> DataFrame:
    return demand.groupBy("category").agg(F.sum("views").alias("views"), F.sum("purchases").alias("purchases"))


def upsell_features(events: DataFrame, alpha: float = 8.0, min_views: int = 100) -> DataFrame:
    """Known categories with enough views: stats, conversion and unscaled opportunity."""
    return (
        category_stats(events)
        .filter(F.col("total_views") >= min_views)
        .withColumn("conversion_rate", ratio(F.col("total_purchases"), F.col("total_views")))
        .withColumn("opportunity_score", _gap(alpha, "total_views", "total_purchases"))
    )


def category_opportunity(demand: DataFrame, config: UpsellConfig = UpsellConfig()) -> DataFrame:
    """Opportunity scaled to [0, 1] over the categories kept; a constant gap scales to 0."""
    kept = _per_category(demand).filter(F.col("views") >= config.min_views).select(
        "category",
        "views",
        "purchases",
        _gap(config.alpha).alias("gap_score"),
        F.try_divide(F.col("purchases").cast("double"), F.col("views")).alias("conversion_rate"),
    )
    limits = kept.agg(F.struct(F.min("gap_score").alias("low"), F.max("gap_score").alias("high")).alias("_limits"))
    low, high = F.col("_limits.low"), F.col("_limits.high")
    scaled = F.when(high > low, (F.col("gap_score") - low) / (high - low)).otherwise(F.lit(0.0))
    return kept.withColumn("_limits", limits.scalar()).withColumn("opportunity_score", scaled).drop("_limits")


def _by_opportunity(demand: DataFrame, config: UpsellConfig) -> list[Row]:
    """The categories recommended from, best first: at most `top_categories` rows."""
    scored = category_opportunity(demand, config).select("category", "opportunity_score")
    return scored.orderBy(F.col("opportunity_score").desc(), "category").take(config.top_categories)


def opportunity_panel(demand: DataFrame, alpha: float = 8.0, n: int = 10) -> DataFrame:
    """Top categories by unscaled opportunity, no minimum of views."""
    scored = _per_category(demand).select("category", _gap(alpha).alias("score"))
    return scored.orderBy(F.col("score").desc(), "category").limit(n)


def top_purchased(demand: DataFrame, n: int) -> list[str]:
    """Names of the n categories with most purchases, best first."""
    bought = _per_category(demand).filter("purchases > 0")
    return [row["category"] for row in bought.orderBy(F.col("purchases").desc(), "category").take(n)]


def _position(names: list[str]) -> Column:
    """0-based position of `category` in a short list of names, -1 if absent."""
    return F.array_position(F.lit(names), F.col("category")) - 1 if names else F.lit(-1).cast("long")


def co_buyers(owned: DataFrame) -> DataFrame:
    """(cat_x, cat_y, buyers) of all categories that some user holds both of, from (user_id, category) rows.

    No pairs are emitted per user: users collapse to distinct baskets with a count, and a basket, which is no larger than
    the catalogue, yields its pairs once, added up before the shuffle.
    """
    baskets = owned.groupBy("user_id").agg(F.sort_array(F.collect_set("category")).alias("basket"))
    counted = baskets.groupBy("basket").agg(F.count("*").alias("users"))
    first = counted.select("users", "basket", F.explode("basket").alias("cat_x"))
    pairs = first.select("users", "cat_x", F.explode("basket").alias("cat_y"))
    return pairs.groupBy("cat_x", "cat_y").agg(F.sum("users").alias("buyers"))


def affinity_counts(demand: DataFrame, n: int = 10) -> DataFrame:
    """Users who bought both, for every pair of the n most purchased categories (diagonal included)."""
    return _counts_among(demand, top_purchased(demand, n))


def _counts_among(demand: DataFrame, names: list[str]) -> DataFrame:
    """Counts for all pairs of a short list of names, zeros included."""
    grid = demand.sparkSession.createDataFrame([(x, y) for x in names for y in names], "cat_x string, cat_y string")
    counts = co_buyers(_bought(demand).select("user_id", "category").filter(F.col("category").isin(names)))
    return grid.join(counts, ["cat_x", "cat_y"], "left").fillna(0, ["buyers"])


def _bought(demand: DataFrame) -> DataFrame:
    return demand.filter("purchases > 0")


def affinity_matrix(demand: DataFrame, n: int = 10, digits: int = 2) -> DataFrame:
    """Co-buyers as a share of the row total, in percent, and as P(bought y | bought x)."""
    return _as_shares(affinity_counts(demand, n), digits)


def _as_shares(counts: DataFrame, digits: int) -> DataFrame:
    row = Window.partitionBy("cat_x")
    own = F.max(F.when(F.col("cat_x") == F.col("cat_y"), F.col("buyers"))).over(row)
    share = F.lit(100) * F.col("buyers") / F.greatest(F.sum("buyers").over(row), F.lit(1))
    return counts.select(
        "cat_x",
        "cat_y",
        "buyers",
        F.round(share, digits).alias("affinity_pct"),
        (F.col("buyers") / own).alias("conditional_prob"),
    )


def copurchase_pairs(demand: DataFrame) -> DataFrame:
    """Buyers shared by every two different categories, whole catalogue."""
    return co_buyers(_owned(demand)).filter("cat_x <> cat_y")


def _owned(demand: DataFrame) -> DataFrame:
    return _bought(demand).select("user_id", "category").distinct()


def copurchase_support(demand: DataFrame) -> DataFrame:
    """Per user and category bought: the number of the user's other categories.

    Equals counting a self-join on user with different category, without the join: each of
    the k categories of a user meets the k - 1 others.
    """
    owned = _owned(demand)
    sizes = owned.groupBy("user_id").agg((F.count("*") - 1).alias("shared_buyers")).filter("shared_buyers > 0")
    return owned.join(sizes, "user_id").select("user_id", F.col("category").alias("target_category"), "shared_buyers")


def _offers(demand: DataFrame, rfm: DataFrame, config: UpsellConfig) -> DataFrame:
    """Per scored user: bit masks of what was bought and the candidates not yet bought.

    The events are read once, into one row per user and category. What follows on the driver
    is bounded by the configuration: the candidate names with their scores and, per candidate,
    the affinity that each of the `affinity_top` categories lends to it (in its last digit).
    """
    if max(config.top_categories, config.affinity_top) > MASK_BITS:
        raise ValueError(f"top_categories and affinity_top must not exceed {MASK_BITS}")
    demand = materialise(user_demand(demand), "user-demand")
    candidates = _by_opportunity(demand, config)
    lenders = top_purchased(demand, config.affinity_top)
    matrix = _as_shares(_counts_among(demand, lenders), config.affinity_digits)
    scale = 10**config.affinity_digits
    lent = {(r["cat_x"], r["cat_y"]): round(r["affinity_pct"] * scale) for r in matrix.collect()}  # affinity_top ** 2
    rows = [
        (i, c["category"], c["opportunity_score"], [lent.get((x, c["category"]), 0) for x in lenders])
        for i, c in enumerate(candidates)
    ]
    schema = "candidates array<struct<bit:int,category:string,opportunity:double,lent:array<bigint>>>"
    listed = demand.sparkSession.createDataFrame([(rows,)], schema)

    def mask(names: list[str]) -> Column:
        position = _position(names)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(position, F.lit(0)).cast("int"))
        return F.bit_or(F.when(position >= 0, bit).otherwise(F.lit(0).cast("long")))

    masks = _bought(demand).groupBy("user_id").agg(
        mask([c["category"] for c in candidates]).alias("owned"), mask(lenders).alias("lending")
    )
    users = rfm.select("user_id", "rfm_score").join(masks, "user_id", "left").fillna(0, ["owned", "lending"])
    open_to = "filter(candidates, c -> (shiftright(owned, c.bit) & 1L) = 0L)"
    return users.withColumn("candidates", listed.scalar()).withColumn("offers", F.expr(open_to))


def upsell_candidates(demand: DataFrame, rfm: DataFrame, config: UpsellConfig = UpsellConfig()) -> DataFrame:
    """Scored users x top categories, minus what each user bought."""
    offers = _offers(demand, rfm, config).select("user_id", F.explode("offers").alias("c"))
    return offers.selectExpr("user_id", "c.category", "c.bit + 1 as opportunity_rank")


def user_scores(
    demand: DataFrame, rfm: DataFrame, config: UpsellConfig = UpsellConfig(), top_k: int | None = None
) -> DataFrame:
    """Weighted opportunity, affinity and customer value per user and candidate category.

    The candidates of a user are an array of bounded length inside one row, so scoring,
    ranking and keeping the best k need no shuffle after the users are assembled.
    """
    full = float(100 * 10**config.affinity_digits)
    lent = "filter(c.lent, (amount, i) -> (shiftright(lending, i) & 1L) = 1L)"
    with_affinity = (
        f"transform(offers, c -> struct(c, least(aggregate({lent}, 0L, (total, amount) -> total + amount) / {full}D, 1D) "
        "as affinity, rfm_score / 15D as weight))"
    )
    combined = (
        f"round({config.opportunity_weight}D * o.c.opportunity + {config.affinity_weight}D * o.affinity "
        f"+ {config.rfm_weight}D * o.weight, 4)"
    )
    scored = (
        f"array_sort(transform(offers, o -> struct(-{combined} as order, o.c.bit as bit, o.c.category as category, "
        "round(o.c.opportunity, 4) as opportunity, round(o.affinity, 4) as affinity, round(o.weight, 4) as rfm_weight, "
        f"{combined} as upsell_score)))"
    )
    best = scored if top_k is None else f"slice({scored}, 1, {top_k})"
    offers = _offers(demand, rfm, config).withColumn("offers", F.expr(with_affinity))
    return offers.selectExpr("user_id", f"posexplode({best}) as (i, s)").selectExpr(
        "user_id",
        "i + 1 as rank",
        "s.category",
        "s.opportunity",
        "s.affinity",
        "s.rfm_weight",
        "s.upsell_score",
    )


def upsell_top_k(demand: DataFrame, rfm: DataFrame, config: UpsellConfig = UpsellConfig()) -> DataFrame:
    """The best `top_k` recommendations per user; equal scores go by opportunity rank."""
    return user_scores(demand, rfm, config, config.top_k)
