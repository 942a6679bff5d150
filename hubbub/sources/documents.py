"""Result rows in the nested document layout of the analytics collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_AGE_AND_ENGAGEMENT = {"ageScore": "age_score", "engagementScore": "engagement_score"}
_CREATOR_COUNTS = {
    "creatorLikedCount": "creator_liked_count",
    "creatorCommentedCount": "creator_commented_count",
    "creatorRecastedCount": "creator_recasted_count",
    "creatorQuotedCount": "creator_quoted_count",
}

# Field -> column, a nested layout, or ``[column, layout]`` for an array of documents.
LAYOUTS = {
    "contentStats": {
        "_id": "content_id",
        "contentId": "content_id",
        "authorId": "author_id",
        "updatedAt": "updated_at",
        "likeCount": "like_count",
        "commentCount": "comment_count",
        "recastCount": "recast_count",
        "quoteCount": "quote_count",
        "photoCount": "photo_count",
        "characterLength": "character_length",
        "aggregator": _AGE_AND_ENGAGEMENT,
        "score": "score",
    },
    "creatorStats": {
        "_id": "creator_id",
        "creatorId": "creator_id",
        "ownerAccount": "owner_account",
        "displayId": "display_id",
        "userCreatedAt": "user_created_at",
        "lastContentUpdatedAt": "last_content_updated_at",
        "followedCount": "followed_count",
        "followerCount": "follower_count",
        "summary": [
            "summary",
            {
                "type": "type",
                "typeCount": "type_count",
                "typeWeight": "type_weight",
                "lastContentUpdatedAt": "last_content_updated_at",
                "aggregator": {**_AGE_AND_ENGAGEMENT, "followedScore": "followed_score"},
                "score": "score",
            },
        ],
        "geolocation": {"countryCode": "country_code", "continentCode": "continent_code"},
        "contentCount": "content_count",
        "aggregator": {**_AGE_AND_ENGAGEMENT, "followedScore": "followed_score"},
        "score": "score",
        **_CREATOR_COUNTS,
    },
    "hashtagStats": {
        "name": "name",
        "__v": "version",
        "createdAt": "created_at",
        "updatedAt": "updated_at",
        "aggregator": {"hastagDiversityScore": "diversity_score", **_AGE_AND_ENGAGEMENT},
        "score": "score",
    },
    "hashtagContributions": {
        "name": "name",
        "part": "part",
        "contributions": ["contributions", {"_id": "author_id", "content": "content_id"}],
    },
    "userStats": {
        "_id": "user_id",
        "ownerAccount": "owner_account",
        "displayId": "display_id",
        "createdAt": "created_at",
        "visibility": "visibility",
        "followedCount": "followed_count",
        "followerCount": "follower_count",
        "userContentCount": "user_content_count",
        "userLikeCount": "user_like_count",
        "userCommentCount": "user_comment_count",
        "userRecastCount": "user_recast_count",
        "userQuoteCount": "user_quote_count",
    },
    "userHashtagSummary": {
        "_id": "author_id",
        "part": "part",
        "hastagSummary": [
            "hashtag_summary",
            {
                "hashtag": "hashtags",
                "hashtagContentCount": "hashtag_content_count",
                "hashtagLikeCount": "hashtag_like_count",
                "hashtagCommentCount": "hashtag_comment_count",
                "hashtagRecastCount": "hashtag_recast_count",
                "hashtagQuoteCount": "hashtag_quote_count",
                "contentSummary": [
                    "content_summary",
                    {
                        "type": "type",
                        "typeCount": "type_count",
                        "likeCount": "like_count",
                        "commentCount": "comment_count",
                        "recastCount": "recast_count",
                        "quoteCount": "quote_count",
                    },
                ],
            },
        ],
    },
    "userEngagementStats": {
        "userId": "user_id",
        "countCommentContentTopic": "comment_topics",
        "countLikeContentTopic": "like_topics",
        "countQuoteContentTopic": "quote_topics",
        "countRecastContentTopic": "recast_topics",
        "countReportContentTopic": "report_topics",
        "timestamp": "timestamp",
    },
    "feedperformances": {
        "personalize_content_feed_score_in_percent": "personal_percent",
        "coldstart_feed_score_in_percent": "global_percent",
        "overall_feed_score_in_percent": "overall_percent",
        "calculatedAt": "calculated_at",
    },
    "userClustered": {
        "userId": "user_id",
        "user_class": "user_class",
        "model": "model",
        "predictedAt": "predicted_at",
    },
    "credentialfeatures": {
        "seenCredential": "seen_credential",
        "firstSeenAt": "first_seen_at",
        "lastSeenAt": "last_seen_at",
        "count": "count",
        "postReadingTimeAbsSkew": "post_reading_time_abs_skew",
        "postReadingTimeAbsKurt": "post_reading_time_abs_kurt",
        "postReadingTimeNormStd": "post_reading_time_norm_std",
        "postReadingTimeDifferenceNormStd": "post_reading_time_difference_norm_std",
        "createdAt": "created_at",
        "updatedAt": "updated_at",
    },
}


def _field(layout, value_of) -> Column:
    if isinstance(layout, str):
        return value_of(layout)
    if isinstance(layout, list):
        column, entry = layout
        return F.transform(value_of(column), lambda item: _struct(entry, lambda name: item[name]))
    return _struct(layout, value_of)


def _struct(layout: dict, value_of) -> Column:
    return F.struct(*[_field(part, value_of).alias(name) for name, part in layout.items()])


def to_documents(collection: str, rows: DataFrame) -> DataFrame:
    """Rows of a result as documents of ``collection``; only selects and nests columns."""
    layout = LAYOUTS[collection]
    return rows.select(*[_field(part, F.col).alias(name) for name, part in layout.items()])
