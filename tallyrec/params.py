"""Parameters of the daily recommender.

Everything a run depends on is a field here so that an operator never reads a
clock or a company-specific string by itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: these must equal the behaviour being reproduced -----------------------------
# Test-group labels and the 0..99 bucket edges that assign them (<= 33, 34..67, >= 68).
GROUP_IN_HOUSE = "in_house_test"
GROUP_HOSTED = "amz_personalize_test"
GROUP_CONTROL = "control"
GROUP_EDGES = (33, 67)
# Feed labels written into the production and outbound tables.
FEED_LABEL_IN_HOUSE = "in_house_rec"
FEED_LABEL_HOSTED = "amz_personalize_rec"
FEED_POST_TYPE = "daily"
OUTBOUND_POST_TYPE_IN_HOUSE = "in_house_daily"
OUTBOUND_POST_TYPE_HOSTED = "amz_personalize_daily"
# Event names of the hosted-recommender export: ratings 1,2 -> view, 3 -> click, 4 -> order.
EVENT_VIEW, EVENT_CLICK, EVENT_ORDER = "view", "click", "order"
# Dummy post id that seeds the seed-history table on day one.
DUMMY_SEED_POST = "1111111"
# Slugs that never describe a post (regex, matched anywhere in the slug).
CATEGORY_EXCLUDE_PATTERN = "(expired|newsletter|uncategorized|black-friday|online-deals|retail|^tip$)"
# Extra stop words: bits of contractions plus domain words.
EXTRA_STOP_WORDS = ["ve", "nt", "ca", "wo", "ll", "free", "clearance", "shipped", "shipping", "subscription"]
# Sentinel for "alias never used" when picking the most recently used subscriber.
NEVER_USED = "2000-01-01 00:00:00"
# Workload sizes.
LOOKBACK_DAYS = 28
EXPIRY_GRACE_HOURS = 8
LOCAL_TZ = "America/Denver"
SAMPLE_USERS = 3000
HEAVY_ALIAS = 20_000  # alias rows of one value above which its users are split over tasks
VOCABULARY_SIZE = 500
SEEDS_PER_USER = 1
CONTENT_CANDIDATES = 42
FINAL_RECS = 20
EXPLORE_THRESHOLD = 0.50
HOSTED_RECS = 20
SPLIT_SEED = 14
TRAIN_FRACTION = 0.85
# Grid of the rating-model search: iteration counts x penalties (3 folds).
GRID_ITERATIONS = (15, 20, 25, 30, 35, 40, 45, 50)
GRID_PENALTIES = (0.01, 0.05)
GRID_FOLDS = 3
# Column order of the CSV hand-offs.
STAGING_COLUMNS = ("post_id", "cim_id", "post_order", "post_title", "permalink", "sim_score", "pred_rating",
                   "more_explore")
HOSTED_STAGING_COLUMNS = ("cim_id", "post_id", "permalink", "score", "post_order")
# -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RunParams:
    """Site-specific strings and knobs; defaults fit the test fixtures."""

    employee_pattern: str = "staff.example.com"
    title_prefix_pattern: str = "https://posts.example.com/..../../../"
    cdn_marker: str = "/wp-content"
    cdn_prefix: str = "https://cdn.example.com/wp-content"
    category_exclude_pattern: str = CATEGORY_EXCLUDE_PATTERN
    lemma_path: str | None = None  # Parquet table (token, lemma); none: tokens stay as they are
    extra_stop_words: tuple[str, ...] = tuple(EXTRA_STOP_WORDS)
    lookback_days: int = LOOKBACK_DAYS
    late_days: int = 1  # days before the run day whose events are read again
    grace_hours: int = EXPIRY_GRACE_HOURS
    local_tz: str = LOCAL_TZ
    sample_users: int = SAMPLE_USERS
    heavy_alias: int = HEAVY_ALIAS
    grid_iterations: tuple[int, ...] = GRID_ITERATIONS
    grid_penalties: tuple[float, ...] = GRID_PENALTIES
    grid_folds: int = GRID_FOLDS
    vocabulary_size: int = VOCABULARY_SIZE
    seeds_per_user: int = SEEDS_PER_USER
    content_candidates: int = CONTENT_CANDIDATES
    final_recs: int = FINAL_RECS
    explore: bool = True
    explore_threshold: float = EXPLORE_THRESHOLD
    hosted_recs: int = HOSTED_RECS
    split_seed: int = SPLIT_SEED
    train_fraction: float = TRAIN_FRACTION
    # Regularisation of the baseline (bias) predictor: b_i uses lambda_item, b_u uses lambda_user.
    lambda_item: float = 10.0
    lambda_user: float = 15.0
    # Largest seed-side row count we are willing to broadcast into the similarity join.
    max_broadcast_rows: int = 5_000_000
    # Event weights of the implicit (hosted-style) recommender.
    implicit_weights: dict = field(default_factory=lambda: {EVENT_VIEW: 1.0, EVENT_CLICK: 2.0, EVENT_ORDER: 3.0})


DEFAULT = RunParams()
