"""Fixed values that must equal the reference's behaviour, kept in one place.

Everything else in the package (block sizes, bucket widths, hash seeds,
encoder choices) is an engine parameter and lives next to its operator.
"""

# Fixed values (reference behaviour) -------------------------------------------------
INTERACTION_TYPES = ("like", "view_full", "comment", "share", "bookmark", "dislike", "report")
RANKING_POSITIVE_TYPES = ("like", "bookmark")
RETRIEVAL_POSITIVE_TYPES = ("like", "bookmark", "view_full")
SEEN_FILTER_TYPES = ("seen", "disliked", "reported")
UNKNOWN_CATEGORY = "unknown_category"

SPLIT_RATIOS = (0.7, 0.15, 0.15)               # train, validation, test
RANKING_NEGATIVE_RATIO = 4                      # negatives per positive (ranking set)
RETRIEVAL_NEGATIVES_PER_POSITIVE = 5            # negatives per positive (retrieval pairs)

TOP_N_CANDIDATES = 100                          # retrieval candidates per user
FINAL_RECOMMENDATIONS = 20                      # re-rank output size
DIVERSITY_FACTOR_DEFAULT = 0.2
DIVERSITY_FACTOR_CONFIGURED = 0.3
DIVERSITY_CAP_OFFSET = 0.2                      # cap = max(1, int(N * (factor + 0.2)))
DIVERSITY_RECENT_WINDOW = 5                     # dominance window over the last chosen items
BOOST_HOURS_DEFAULT, BOOST_FACTOR_DEFAULT = 24.0, 1.1
BOOST_HOURS_CONFIGURED, BOOST_FACTOR_CONFIGURED = 48.0, 1.2
SMOKE_SCORE_MATCH, SMOKE_SCORE_OTHER = 0.8, 0.3

CLASSIFICATION_THRESHOLD = 0.5
TOP_K_ACCURACY_KS = (1, 5, 10, 50, 100)
GBT_PARAMS = {"maxDepth": 7, "maxIter": 100, "stepSize": 0.01}
TOWER_DIM = 64
TEXT_EMBEDDING_DIM = 384
TOWER_BATCH_SIZE = 256
DEMO_FEATURE_TTL = "1 day"

SCORE_MARKER = "Probability:"
ITEM_SEPARATOR = " | "
DESCRIPTION_SEPARATOR = " @ "
DEFAULT_EMOJI = "\U0001F537"
DEFAULT_ITEM_CATEGORY = "Item"
NO_SUMMARY = "No summary available."
