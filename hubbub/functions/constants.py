"""These must match the analytics jobs this library replaces."""

# Engagement types that score content, in the order used throughout.
ENGAGEMENT_TYPES = ("like", "comment", "recast", "quote")

# Engagement types with a topic map.
TOPIC_MAP_TYPES = ("comment", "like", "quote", "recast", "report")

# Interaction strength by engagement type.
EVENT_STRENGTH = {"comment": 1.5, "like": 1.0, "quote": 2.5, "recast": 2.0}

# Model features of one content.
CONTENT_FEATURES = (
    "like_count",
    "comment_count",
    "recast_count",
    "quote_count",
    "photo_count",
    "character_length",
    "creator_content_count",
    "creator_liked_count",
    "creator_commented_count",
    "creator_recasted_count",
    "creator_quoted_count",
    "age_score",
)

# Reading-behaviour features of one credential.
CREDENTIAL_FEATURES = (
    "post_reading_time_abs_skew",
    "post_reading_time_abs_kurt",
    "post_reading_time_norm_std",
    "post_reading_time_difference_norm_std",
)

# Topic labels compared with message vectors.
TOPIC_LABELS = (
    "Smartphones",
    "Business",
    "Entertainment",
    "Politics",
    "Science",
    "Colleges",
    "Country",
    "Technology",
    "Weather",
    "Food and health",
    "Financial",
    "Exercise",
    "Photography",
    "Horoscope",
    "Sports",
    "Travel",
    "Celebrity",
    "Shopping",
    "Cryptocurrency",
    "Religion",
    "Television programmes",
    "Drug",
    "Weapon",
    "Pornographic",
    "Violence",
    "Hate speech",
)

# Class codes of the one-class model.
BOT_CLASS = 0
HUMAN_CLASS = 1
CLASS_NAMES = {BOT_CLASS: "bot_class", HUMAN_CLASS: "human_class"}
ONE_CLASS_MODEL = "one-class classifier based on PCA"
