"""Document schemas of the collections, and of change events."""

from __future__ import annotations

from pyspark.sql.types import StructType

_COUNT = "struct<count:bigint>"

COLLECTIONS = {
    "contents": (
        "_id string, author struct<id:string>, type string, visibility string, "
        "createdAt timestamp, updatedAt timestamp, "
        "payload struct<message:string, photo:struct<contents:array<string>>>, "
        f"engagements struct<like:{_COUNT}, comment:{_COUNT}, recast:{_COUNT}, quote:{_COUNT}>, "
        "hashtags struct<payload:array<string>>, originalId string, __v int"
    ),
    "engagements": (
        "_id string, user string, type string, targetRef struct<ref:string, id:string>, "
        "visibility string, itemId string, createdAt timestamp, updatedAt timestamp"
    ),
    "users": (
        "_id string, ownerAccount string, displayId string, visibility string, "
        "createdAt timestamp, followedCount bigint, followerCount bigint"
    ),
    "accounts": "_id string, geolocation struct<countryCode:string, continentCode:string>",
    "feeditems": (
        "_id string, viewer string, content string, "
        "analytics struct<score:double, source:string>, seenCredential string, "
        "seenAt timestamp, offScreenAt timestamp, createdAt timestamp, updatedAt timestamp"
    ),
    "contentinfo": (
        "contentId string, language string, topics array<string>, translatedEN string, "
        "updatedAt timestamp"
    ),
    "contentfiltering": (
        "_id string, contentId string, language string, massageInEN string, "
        "topic_classify struct<class:string, score:double>"
    ),
    "topics": (
        "_id string, slug string, parents array<struct<_id:string, slug:string>>, "
        "children array<struct<_id:string, slug:string>>, parentsSlug array<string>, "
        "childrenSlug array<string>, createdAt timestamp, updatedAt timestamp"
    ),
    "credentialfeatures": (
        "seenCredential string, firstSeenAt timestamp, lastSeenAt timestamp, count bigint, "
        "postReadingTimeAbsSkew double, postReadingTimeAbsKurt double, "
        "postReadingTimeNormStd double, postReadingTimeDifferenceNormStd double, "
        "verificationStatus boolean, verifiedAt timestamp, createdAt timestamp, "
        "updatedAt timestamp"
    ),
    "suspiciouscredentials": (
        "_id string, seenCredential string, firstSeenAt timestamp, lastSeenAt timestamp, "
        "verificationStatus boolean, verifiedAt timestamp, createdAt timestamp"
    ),
}

CHANGE_EVENT = (
    "version string, id string, `detail-type` string, source string, account string, "
    "time string, region string, resources array<string>, "
    "detail struct<operationType:string, "
    "fullDocument:struct<_id:string, payload:struct<message:string>, updatedAt:string, "
    "category:string, categories:array<struct<name:string, confidence:double>>, confidence:double, translatedEN:string, detectedLanguage:string>, "
    "ns:struct<db:string, coll:string>, documentKey:struct<_id:string>>"
)


def schema_of(collection: str) -> StructType:
    return StructType.fromDDL(COLLECTIONS[collection])
