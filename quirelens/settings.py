"""Fixed values, schemas and session helpers shared by the package."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Patterns.
TOKEN_PATTERN = r"[\p{L}\p{M}\p{N}_]+(?:['’.][\p{L}\p{M}\p{N}_]+)*"
ID_PREFIX_PATTERN = r"https://[^/]+/extracted-features/\d+/"
CATALOG_RECORD_PATTERN = r"^https://catalog\.[^/]+/Record/"
CONCEPT_PAGE_PATTERN = r"(\d{6})\.txt$"

# Index field suffixes.
TOKENS_SUFFIX = "_htrctokentext"
PAGE_FACET_SUFFIX = "_htrcstring"
PAGE_FACETS_SUFFIX = "_htrcstrings"
PAGE_TEXT_SUFFIX = "_txt"
VOLUME_TEXT_SUFFIX = "_t"
VOLUME_FACET_SUFFIX = "_s"
VOLUME_FACETS_SUFFIX = "_ss"
INT_SUFFIX = "_i"
VOLUME_ID_FIELD = "volumeid_s"
NO_TEXT_FIELD = "efnotext_b"
ALL_LANGS = "alllangs"

# Part-of-speech defaults.
UNMAPPED_TAG = "X"
UNKNOWN_SOURCE_TAG = "UKN"

# Update commands and sizing.
COMMIT_WITHIN = 120000
DELIVERY_ATTEMPTS = 10
FILES_PER_PARTITION = 3000
MIN_PARTITIONS = 100
SAMPLE_SEED = 42
BLOOM_FPP = 0.01

# Metadata names, record version 2.
V2_STRINGS = ["accessProfile", "accessRights", "id", "title"]
V2_INTS = ["dateCreated", "lastRightsUpdateDate", "pubDate"]
V2_URIS = ["schemaVersion", "typeOfResource"]
V2_MULTI = ["language", "oclc"]
V2_MULTI_URIS = ["genre"]
V2_ENTITIES = ["contributor", "publisher", "pubPlace"]
ORGANIZATION_TYPE = "http://id.loc.gov/ontologies/bibframe/Organization"
FEED_ITEM_TYPE = "DataFeedItem"
DROPPED_URI_PREFIX = "urn:uuid"

# Metadata names, record version 1.5.
V15_STRINGS = [
    "accessProfile", "bibliographicFormat", "dateCreated", "handleUrl", "htBibUrl", "imprint",
    "issuance", "language", "lastUpdateDate", "pubDate", "pubPlace", "rightsAttributes",
    "schemaVersion", "sourceInstitution", "sourceInstitutionRecordNumber", "title", "typeOfResource", "volumeIdentifier",
]
V15_MULTI = ["oclc", "isbn", "issn", "lccn", "genre", "names"]
V15_MAPS = ["classification"]

ZONES = ["header", "body", "footer"]

TOKEN_MAP, CHAR_MAPS = "tokenPosCount", ["beginCharCounts", "endCharCount"]

# Record schemas. Metadata stays a string here: its values are polymorphic. So do counts, as one odd number must not
# lose its page, and the page count, which some records give as text.
ZONE_DDL = (
    "struct<tokenPosCount: map<string, map<string, string>>, "
    "beginCharCounts: map<string, string>, endCharCount: map<string, string>>"
)
PAGE_DDL = {
    "2": f"struct<seq: string, calculatedLanguage: string, header: {ZONE_DDL}, body: {ZONE_DDL}, footer: {ZONE_DDL}>",
    "1.5": f"struct<seq: string, languages: array<map<string, string>>, header: {ZONE_DDL}, body: {ZONE_DDL}, footer: {ZONE_DDL}>",
}
CONCEPT_DDL = "documentId string, collectionName string, pageId string, concepts array<struct<text: string>>"
CONCEPT_VOLUME_DDL = "volId string, pages array<struct<concepts: array<struct<text: string>>>>"

# Sizes below which a side table may be broadcast or embedded in the plan.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
EMBED_MAX_ROWS = 20_000


#: Holds the text of a record of which the parser could not take some part.
DAMAGED = "_damaged"


def volume_ddl(version: str = "2", pages: bool = True) -> str:
    listed = f", pages: array<{PAGE_DDL[version]}>" if pages else ""
    return f"id string, metadata string, features struct<pageCount: string{listed}>, {DAMAGED} string"


def build_session(app_name: str = "quirelens", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the package is measured with; a cluster's own settings win where given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, it lies beside the session's tables: on a cluster the warehouse must then be shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
