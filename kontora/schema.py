"""The organisation table: columns, types, defaults and statuses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PENDING, FREEMAIL, DEAD, LIVE, PARKED = "pending", "freemail", "dead", "live", "parked"
ERROR, MX_ONLY, BLOCKED, AGED_OUT = "error", "mx_only", "blocked", "aged_out"
STATUSES = (PENDING, FREEMAIL, DEAD, LIVE, PARKED, ERROR, MX_ONLY, BLOCKED, AGED_OUT)

TIER1, TIER2, TIER3, DROPPED = "tier1_email", "tier2_ads", "tier3_nurture", "dropped"

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType()}


def struct(columns: str) -> T.StructType:
    """A schema of ``name type`` pairs, which unlike DDL needs no session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in columns.split(", "))])


_IDENTITY = "target_key string, domain string, email string, local_part string, created timestamp_ntz, created_year int, email_count int, is_freemail int, is_role int, tld string, jurisdiction string, source_file string, source_sheet string, status string"
_DNS = "dns_resolves int, a_host string, has_mx int, mx_provider string, dns_error string, dns_attempts int, dns_checked_at timestamp"
_HTTP = "http_status int, final_url string, page_title string, response_time_ms int, content_length int, platform string, has_cart int, has_product_schema int, is_parked int, lang string, robots_allowed int, http_error string, http_attempts int, http_checked_at timestamp"
_SCORE = "score int, tier string, tier_reason string, scored_at timestamp"
_PROFILE = "linkedin_url string, linkedin_kind string, image_count int, images_no_alt int, images_lazy int, images_srcset int, images_offsite int, images_modern int, has_og_image int, has_meta_desc int, sample_image_url string, sample_image_bytes bigint, sample_image_type string, legal_url string, owner_name string, owner_source string, profile_error string, profile_attempts int, profile_checked_at timestamp"
_VERIFY = "verify_status string, verify_result string, verified_at timestamp"

#: Columns by the stage that owns them.
GROUPS = {"identity": _IDENTITY, "dns": _DNS, "http": _HTTP, "score": _SCORE, "profile": _PROFILE, "verify": _VERIFY}
TARGETS = struct(", ".join(GROUPS.values()))
LEDGER = struct("path string, size bigint, mtime bigint, rows bigint, emails bigint, new_targets bigint, ingested_at timestamp")
DEFAULTS = {"email_count": 1, "is_freemail": 0, "is_role": 0, "status": PENDING, "dns_attempts": 0, "http_attempts": 0, "profile_attempts": 0}

DNS_FIELDS = [f.name for f in struct(_DNS).fields if f.name not in ("dns_attempts", "dns_checked_at")]
HTTP_FIELDS = [f.name for f in struct(_HTTP).fields if f.name not in ("http_attempts", "http_checked_at")]
PROFILE_FIELDS = [f.name for f in struct(_PROFILE).fields if f.name not in ("profile_attempts", "profile_checked_at")]


def conform(df: DataFrame, schema: T.StructType = TARGETS) -> DataFrame:
    """``df`` in the canonical shape: missing columns are added, defaults filled.

    Evolution is additive only: columns the schema doesn't know are dropped.
    """
    present = set(df.columns)
    columns = []
    for f in schema.fields:
        value = F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)
        if f.name in DEFAULTS:
            value = F.coalesce(value, F.lit(DEFAULTS[f.name]).cast(f.dataType))
        columns.append(value.alias(f.name))
    return df.select(*columns)
