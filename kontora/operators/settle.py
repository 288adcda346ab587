"""One settle-and-retry operator for the DNS, HTTP and profile stages.

A conclusive verdict writes all fields and stamps the row.  An inconclusive one
counts an attempt and leaves the stamp unset, so the row comes up again; at the
last attempt it is stamped with the stage's terminal values.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontora import schema as S
from kontora.functions.rules import MAX_ATTEMPTS


class Stage(NamedTuple):
    name: str  # prefix of the attempts and checked_at columns
    fields: list[str]  # written by a conclusive verdict
    #: field -> value of an inconclusive verdict, from (old, new, is terminal)
    unsettled: dict[str, Callable[[Column, Column, Column], Column]]


_keep_new = lambda old, new, last: new
_zero_or_null = lambda old, new, last: F.when(last, F.lit(0))

DNS = Stage("dns", [*S.DNS_FIELDS, "status"], {"dns_error": _keep_new, "dns_resolves": _zero_or_null, "has_mx": _zero_or_null, "status": lambda o, n, last: F.when(last, S.DEAD).otherwise(o)})
HTTP = Stage(
    "http",
    [*S.HTTP_FIELDS, "status"],
    {"http_error": _keep_new, "response_time_ms": _keep_new, "status": lambda o, n, last: F.when(last, F.when(n == S.BLOCKED, S.BLOCKED).otherwise(S.DEAD)).otherwise(o)},
)
PROFILE = Stage("profile", S.PROFILE_FIELDS, {"profile_error": _keep_new})


def settle(targets: DataFrame, verdicts: DataFrame, stage: Stage, now: Column, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """``targets`` with ``verdicts`` (domain, fields, inconclusive) written in.

    Only store rows can match, since domains are unique among those alone; the
    others, of which many share a domain, never enter the join.  A null status of a
    verdict leaves the status.  One left join on the domain.
    """
    attempts, stamp = f"{stage.name}_attempts", f"{stage.name}_checked_at"
    store = F.coalesce(F.col("is_freemail") == 0, F.lit(False))
    joined = targets.filter(store).alias("t").join(verdicts.alias("v"), F.col("t.domain") == F.col("v.domain"), "left")
    hit, open_ = F.col("v.domain").isNotNull(), F.coalesce(F.col("v.inconclusive"), F.lit(False))
    last = F.col(f"t.{attempts}") + 1 >= max_attempts
    columns = []
    for c in targets.columns:
        old = F.col(f"t.{c}")
        if c == attempts:
            value = F.when(hit, old + 1).otherwise(old)
        elif c == stamp:
            value = F.when(hit & open_, F.when(last, now)).when(hit, now).otherwise(old)
        elif c in stage.fields:
            new = F.col(f"v.{c}")
            settled = F.coalesce(new, old) if c == "status" else new
            unsettled = stage.unsettled[c](old, new, last) if c in stage.unsettled else old
            value = F.when(hit & open_, unsettled).when(hit, settled).otherwise(old)
        else:
            value = old
        columns.append(value.cast(targets.schema[c].dataType).alias(c))
    return joined.select(*columns).unionByName(targets.filter(~store))
