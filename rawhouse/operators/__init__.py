"""DataFrame -> DataFrame operators (see README "Coverage")."""

from rawhouse.operators.entity import (
    attribute_peers, cluster_peers, entity_card, entity_facts, entity_measures, entity_stats,
    group_sums, similar_entities, target_facts, top_items,
)
from rawhouse.operators.graph import cooccurrence_degree, smooth_features
from rawhouse.operators.ml import cluster
from rawhouse.operators.model import (
    build_dictionary, build_dimension, distinct_profile, explode_zipped, first_per_key,
    merge_sources, normalize, parse_list, prefixed,
)
from rawhouse.operators.parse import clean_profile, html_cell_pairs, match_posts, parse_kv_profile, parse_posts
from rawhouse.operators.percentile import percentiles
from rawhouse.operators.ranking import label_frequency, percentile_board, tag_frequency
from rawhouse.operators.timeseries import (
    category_series, daily_metrics, grouped_corr, indicator_runs, moving_average, top_k_mean,
    trend_runs, with_trend, year_range,
)

__all__ = [
    "attribute_peers", "cluster_peers", "entity_card", "entity_facts", "entity_measures", "entity_stats",
    "group_sums", "similar_entities", "target_facts", "top_items",
    "cooccurrence_degree", "smooth_features", "cluster",
    "build_dictionary", "build_dimension", "distinct_profile", "explode_zipped", "first_per_key",
    "merge_sources", "normalize", "parse_list", "prefixed",
    "clean_profile", "html_cell_pairs", "match_posts", "parse_kv_profile", "parse_posts",
    "percentiles", "label_frequency", "percentile_board", "tag_frequency",
    "category_series", "daily_metrics", "grouped_corr", "indicator_runs", "moving_average", "top_k_mean",
    "trend_runs", "with_trend", "year_range",
]
