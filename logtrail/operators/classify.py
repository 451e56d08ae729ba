"""Operational JSON lines -> 18 classification columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logtrail.functions.identity import map_value
from logtrail.functions.jsontext import strict_json_lines, truthy, value_text
from logtrail.operators.once import compute_once
from logtrail.schemas import OBSOLETE_COLUMNS

# Names of the operational events and the text of a served site.
EXECUTION = "lambda_execution"
DECISION = "access_decision"
DEPLOY = "deploy_triggered"
DESTROY = "destroy_triggered"
UNTRUSTED_ON_ACTIVE = "active_site_untrusted_access"
SITE_SERVED_TEXT = "servindo site via proxy s3"

# State -> reason for analysis.
ANALYSIS_REASONS = {
    "aguardando_criacao": "refresh_aguardando_apply",
    "criou_ambiente": "primeiro_acesso_disparou_apply",
    "site_servido": "acesso_site_servido",
    "site_servido_nao_confiavel": "bot_ou_preview_em_ambiente_ativo",
    "eventbridge_destroy": "destroy_automatico",
    "eventbridge_timeout": "validacao_timeout_eventbridge",
}
OTHER_REASON = "classificacao_indefinida"


def with_operational_events(records: DataFrame) -> DataFrame:
    """Add `ops`: the operational JSON lines of the execution, in line order."""
    ops = strict_json_lines(F.coalesce("block_text", F.lit("")))
    return records.withColumn("ops", ops).transform(compute_once, ["ops"])


def last_event(name: str) -> Column:
    """The last operational event of that name (variant), null when absent."""
    return F.try_element_at(F.filter("ops", lambda op: op["event"] == name), F.lit(-1))["doc"]


def _text(doc: str, field: str) -> Column:
    return F.coalesce(value_text(F.col(doc), f"$.{field}"), F.lit(""))


def _served(text: Column) -> Column:
    """The text of a served site in any case. Only a text that holds its last two characters is lowered."""
    return F.when(text.contains("s3") | text.contains("S3"), F.lower(text).contains(SITE_SERVED_TEXT)).otherwise(False)


def classify_accesses(records: DataFrame) -> DataFrame:
    """Needs block_text, is_http_event; the inputs temp_item and active_items do not become columns."""
    base = with_operational_events(records.drop(*OBSOLETE_COLUMNS)).withColumns(
        {
            "_execution": last_event(EXECUTION),
            "_decision": last_event(DECISION),
            "_destroy": last_event(DESTROY),
            "disparou_apply": last_event(DEPLOY).isNotNull(),
            "active_site_untrusted_access": last_event(UNTRUSTED_ON_ACTIVE).isNotNull(),
        }
    )
    computed = {
        "origem_eventbridge": truthy(F.col("_execution"), "$.origem_eventbridge"),
        "_temp_item": truthy(F.col("_execution"), "$.temp_item"),
        "_active_items": F.coalesce(
            F.try_variant_get(F.col("_execution"), "$.active_items", "double").try_cast("int"), F.lit(0)
        ),
        "status_confianca": F.when(F.col("_decision").isNull(), "")
        .when(truthy(F.col("_decision"), "$.trusted"), "trusted")
        .otherwise("untrusted"),
        "motivo_confianca": _text("_decision", "reason"),
        "decision_user_agent": _text("_decision", "user_agent"),
        "disparou_destroy": F.col("_destroy").isNotNull(),
        "last_accessed_at": _text("_destroy", "last_accessed_at"),
        "expiration_time": _text("_destroy", "expiration_time"),
        "bucket_name": F.coalesce(
            F.nullif(_text("_destroy", "bucket"), F.lit("")), _text("_execution", "bucket")
        ),
        "serviu_site": _served(F.coalesce("block_text", F.lit(""))),
    }
    facts = base.withColumns(computed).transform(compute_once, [*computed, "disparou_apply", "active_site_untrusted_access"])
    apply, destroy, scheduled = F.col("disparou_apply"), F.col("disparou_destroy"), F.col("origem_eventbridge")
    untrusted_on_active, served = F.col("active_site_untrusted_access"), F.col("serviu_site")
    status = F.col("status_confianca")
    flags = facts.withColumns(
        {
            "event_type": F.when(destroy, DESTROY)
            .when(apply, DEPLOY)
            .when(untrusted_on_active, UNTRUSTED_ON_ACTIVE)
            .when(F.col("_decision").isNotNull(), DECISION)
            .when(F.col("_execution").isNotNull(), EXECUTION)
            .otherwise(""),
            "aguardando_criacao": F.col("_temp_item") & F.coalesce("is_http_event", F.lit(False)) & ~apply,
            "renovou_timeout": (status == "trusted") & served & ~apply & ~destroy & ~scheduled,
            "deploy_avoided": ~scheduled
            & (status == "untrusted")
            & ~apply
            & (F.col("_active_items") == 0)
            & ~F.col("_temp_item"),
        }
    )
    stated = flags.withColumn(
        "estado_resposta",
        F.when(scheduled & destroy, "eventbridge_destroy")
        .when(scheduled, "eventbridge_timeout")
        .when(apply, "criou_ambiente")
        .when(F.col("aguardando_criacao"), "aguardando_criacao")
        .when(untrusted_on_active, "site_servido_nao_confiavel")
        .when(served, "site_servido")
        .otherwise("indefinido"),
    )
    return stated.withColumns(
        {
            "manter_para_analise": F.col("estado_resposta") != "aguardando_criacao",
            "motivo_analise": map_value(F.col("estado_resposta"), ANALYSIS_REASONS, OTHER_REASON),
        }
    ).drop("ops", "_execution", "_decision", "_destroy", "_temp_item", "_active_items")
