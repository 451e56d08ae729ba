"""Visitor identity and visitor type."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Reason of the access decision -> visitor type.
VISITOR_TYPES = {
    "allowed_search_bot": "crawler_buscador",
    "social_preview_bot": "social_preview",
    "scanner_agent": "scanner",
    "suspicious_path": "scanner",
    "non_get_method": "scanner",
    "no_user_agent": "bot_generico",
    "missing_accept_header": "bot_generico",
    "missing_accept_language_allowed": "humano_provavel",
    "all_checks_passed": "humano_provavel",
}
OTHER_VISITOR_TYPE = "bot_generico"
UNKNOWN_NETWORK = "unknown_network"


def map_value(key: Column, mapping: dict[str, str], default: str) -> Column:
    pairs = F.create_map(*[F.lit(part) for part in chain(*mapping.items())])
    return F.coalesce(pairs[key], F.lit(default))


def short_hash(text: Column) -> Column:
    return F.sha2(text, 256).substr(1, 16)


def visitor_id(prefix: Column, user_agent: Column) -> Column:
    network = F.when(prefix == "", UNKNOWN_NETWORK).otherwise(prefix)
    return short_hash(F.concat_ws("|", network, user_agent))


def visitor_type(reason: Column) -> Column:
    return F.when(reason == "", "").otherwise(map_value(reason, VISITOR_TYPES, OTHER_VISITOR_TYPE))


def session_hash(request_id: Column) -> Column:
    return short_hash(F.coalesce(request_id, F.lit("")))
