"""Wording of alerts and classification of failures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds of failure and what their messages contain, in order of precedence.
PROBES = (
    ("quota_exhausted", ("quota", "eecu", "restricted mode", "rate limit", "429", "resource_exhausted", "resource exhausted")),
    ("project_not_registered", ("not registered", "not signed up", "is not a valid project", "no project found", "project not found", "has not been used", "not found or deleted")),
    ("network", ("certificate verify failed", "certificate_verify_failed", "sslerror", "ssl:", "max retries exceeded", "connection", "timed out", "timeout", "temporary failure", "unreachable", "name resolution")),
    ("not_authenticated", ("authenticate", "authorize", "credential", "not initialized", "invalid_grant", "token has been expired", "token has been revoked", "invalid token", "401")),
    ("permission_denied", ("permission", "forbidden", "403", "access denied", "caller does not have")),
)
#: What to do about each kind.
REMEDIES = {
    "config_missing": "Name the project and the credentials in the settings.",
    "quota_exhausted": "The monthly compute quota is used up; try again in the next cycle.",
    "project_not_registered": "Register the cloud project for raster access, or correct its id.",
    "network": "The service could not be reached; check proxy, certificates and connection.",
    "not_authenticated": "No valid credentials; sign in again or name a key file.",
    "permission_denied": "The account lacks a role on the project; ask its owner.",
    "unknown": "Unrecognised failure; see the original message.",
}


def error_kind(message: Column) -> Column:
    low, out = F.lower(message), None
    for kind, probes in PROBES:
        hit = F.lit(False)
        for p in probes:
            hit = hit | low.contains(p)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("unknown")


def remedy(kind: Column) -> Column:
    return F.create_map(*(F.lit(x) for kv in REMEDIES.items() for x in kv))[kind]


def size_description(ha: Column) -> Column:
    return F.when(ha < 1, F.concat(F.lit("about "), F.format_number(F.bround(ha * 10000, 0), 0), F.lit(" square metres"))).when(ha < 10, F.concat(F.lit("roughly "), F.format_string("%.1f", F.bround(ha, 1)), F.lit(" football pitches"))).otherwise(F.concat(F.lit("about "), F.format_string("%.0f", F.bround(ha, 0)), F.lit(" hectares")))


def status(notified: Column, confirmations: Column) -> Column:
    passes = F.when(confirmations == 1, " pass, awaiting more").otherwise(" passes, awaiting more")
    return F.when(notified.isNotNull(), "confirmed on multiple passes - requires ground verification").otherwise(F.concat(F.lit("UNCONFIRMED - seen "), confirmations.cast("string"), passes))
