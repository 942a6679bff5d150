"""Reading collections: explicit schemas, then flat working columns.

The flat form is what every operator takes. Flattening only selects nested fields, so Parquet
scans still read just the leaves an operator uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubbub.sources.schemas import schema_of

# Flat name -> document path, per collection.
FLAT_COLUMNS = {
    "contents": {
        "content_id": "_id",
        "author_id": "author.id",
        "type": "type",
        "visibility": "visibility",
        "message": "payload.message",
        "photos": "payload.photo.contents",
        "like_count": "engagements.like.count",
        "comment_count": "engagements.comment.count",
        "recast_count": "engagements.recast.count",
        "quote_count": "engagements.quote.count",
        "hashtags": "hashtags.payload",
        "original_id": "originalId",
        "version": "__v",
        "created_at": "createdAt",
        "updated_at": "updatedAt",
    },
    "engagements": {
        "id": "_id",
        "user_id": "user",
        "type": "type",
        "target_ref": "targetRef.ref",
        "content_id": "targetRef.id",
        "created_at": "createdAt",
        "updated_at": "updatedAt",
    },
    "users": {
        "user_id": "_id",
        "owner_account": "ownerAccount",
        "display_id": "displayId",
        "visibility": "visibility",
        "created_at": "createdAt",
        "followed_count": "followedCount",
        "follower_count": "followerCount",
    },
    "accounts": {
        "account_id": "_id",
        "country_code": "geolocation.countryCode",
        "continent_code": "geolocation.continentCode",
    },
    "feeditems": {
        "id": "_id",
        "viewer": "viewer",
        "content_id": "content",
        "score": "analytics.score",
        "source": "analytics.source",
        "seen_credential": "seenCredential",
        "seen_at": "seenAt",
        "off_screen_at": "offScreenAt",
        "updated_at": "updatedAt",
    },
    "contentinfo": {
        "content_id": "contentId",
        "language": "language",
        "topics": "topics",
        "translated_en": "translatedEN",
        "updated_at": "updatedAt",
    },
    "contentfiltering": {
        "content_id": "contentId",
        "language": "language",
        "message_en": "massageInEN",
        "class": "topic_classify.class",
        "class_score": "topic_classify.score",
    },
    "topics": {
        "topic_id": "_id",
        "slug": "slug",
        "parents": "parents",
        "children": "children",
        "parents_slug": "parentsSlug",
        "children_slug": "childrenSlug",
        "created_at": "createdAt",
        "updated_at": "updatedAt",
    },
    "credentialfeatures": {
        "seen_credential": "seenCredential",
        "first_seen_at": "firstSeenAt",
        "last_seen_at": "lastSeenAt",
        "count": "count",
        "post_reading_time_abs_skew": "postReadingTimeAbsSkew",
        "post_reading_time_abs_kurt": "postReadingTimeAbsKurt",
        "post_reading_time_norm_std": "postReadingTimeNormStd",
        "post_reading_time_difference_norm_std": "postReadingTimeDifferenceNormStd",
        "verification_status": "verificationStatus",
        "verified_at": "verifiedAt",
        "created_at": "createdAt",
        "updated_at": "updatedAt",
    },
    "suspiciouscredentials": {
        "id": "_id",
        "seen_credential": "seenCredential",
        "first_seen_at": "firstSeenAt",
        "last_seen_at": "lastSeenAt",
        "verification_status": "verificationStatus",
        "verified_at": "verifiedAt",
        "created_at": "createdAt",
    },
}


def read_documents(
    spark: SparkSession, collection: str, path: str, file_format: str = "parquet"
) -> DataFrame:
    """Scan exported documents with the collection's declared schema (no inference)."""
    return spark.read.schema(schema_of(collection)).format(file_format).load(path)


def flatten(collection: str, documents: DataFrame) -> DataFrame:
    """Documents of one collection as flat working columns."""
    return documents.select(
        *[F.col(path).alias(name) for name, path in FLAT_COLUMNS[collection].items()]
    )


def read_collection(
    spark: SparkSession, collection: str, path: str, file_format: str = "parquet"
) -> DataFrame:
    return flatten(collection, read_documents(spark, collection, path, file_format))
