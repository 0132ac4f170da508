"""Job parameters. Every threshold an analyst may want to move lives here."""

from __future__ import annotations

from dataclasses import dataclass

# Event types, feature names and their order.
EVENT_TYPES = ("view", "cart", "purchase")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
CHURN_FEATURES = (
    "frequency",
    "monetary",
    "avg_price",
    "recency",
    "unique_cats",
    "unique_brands",
    "unique_prods",
    "n_views",
    "n_carts",
    "cart_to_pur_ratio",
)
DEDUP_KEYS = ("user_id", "user_session", "event_time", "event_type", "product_id")


# The defaults below.
@dataclass(frozen=True)
class SilverConfig:
    bot_limit: int = 500


@dataclass(frozen=True)
class RfmConfig:
    ref_date: str = "2019-12-01"
    method: str = "percent_rank"  # or "qcut", "ntile"
    recency: str = "elapsed"  # or "calendar"
    bins: int = 5
    min_purchase_price: float | None = None


@dataclass(frozen=True)
class ChurnConfig:
    """Features come from [start, cut), the label from [cut, end)."""

    start: str = "2019-10-01"
    cut: str = "2019-11-01"
    end: str = "2019-12-01"
    ref_date: str | None = None  # default: cut

    @property
    def reference(self) -> str:
        return self.ref_date or self.cut


@dataclass(frozen=True)
class UpsellConfig:
    alpha: float = 8.0
    min_views: int = 10
    top_categories: int = 20
    affinity_top: int = 10
    affinity_digits: int = 2
    top_k: int = 5
    opportunity_weight: float = 0.5
    affinity_weight: float = 0.3
    rfm_weight: float = 0.2


@dataclass(frozen=True)
class ModelConfig:
    seed: int = 42
    test_percent: int = 20
    folds: int = 5
    lr_iterations: int = 1000
    lr_tolerance: float = 1e-4
    rf_trees: int = 150
    rf_depth: int = 6
    gbt_iterations: int = 200
    gbt_depth: int = 4
    gbt_step: float = 0.05
    gbt_subsample: float = 0.85
    min_auc: float = 0.60
