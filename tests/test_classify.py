from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from logtrail.operators import classify
from logtrail.operators.classify import classify_accesses
from logtrail.schemas import CLASSIFY_COLUMNS


def op(event, **fields):
    return json.dumps({"event": event, **fields})


def execution(eventbridge=False, temp=False, items=0, bucket=None):
    return op("lambda_execution", origem_eventbridge=eventbridge, temp_item=temp, active_items=items, bucket=bucket)


def decision(trusted, reason="all_checks_passed"):
    return op("access_decision", trusted=trusted, reason=reason, user_agent="ua")


DESTROY = op("destroy_triggered", bucket="b-2", last_accessed_at="t1", expiration_time="t2")


def one(spark, *lines, http=True):
    df = spark.createDataFrame(
        [("r", http, "\n".join(lines), True)],
        "request_id string, is_http_event boolean, block_text string, ambiente_ativo boolean",
    )
    return classify_accesses(df).first()


CASES = {
    "criou_ambiente": ([execution(), decision(True), op("deploy_triggered")], True,
                       dict(disparou_apply=True, event_type="deploy_triggered", bucket_name="",
                            motivo_analise="primeiro_acesso_disparou_apply", manter_para_analise=True)),
    "eventbridge_destroy": ([execution(True, False, 1, "b-1"), DESTROY], False,
                            dict(disparou_destroy=True, bucket_name="b-2", last_accessed_at="t1", expiration_time="t2",
                                 event_type="destroy_triggered", motivo_analise="destroy_automatico")),
    "eventbridge_timeout": ([execution(True, False, 1, "b-1")], False,
                            dict(status_confianca="", motivo_confianca="", decision_user_agent="", bucket_name="b-1",
                                 event_type="lambda_execution", motivo_analise="validacao_timeout_eventbridge")),
    "indefinido": ([execution(), decision(False, "missing_accept_header"), op("access_rejected")], True,
                   dict(status_confianca="untrusted", motivo_confianca="missing_accept_header", deploy_avoided=True,
                        event_type="access_decision", motivo_analise="classificacao_indefinida")),
    "site_servido": ([execution(False, False, 1, "b-1"), decision(True), "Servindo site via proxy S3"], True,
                     dict(serviu_site=True, renovou_timeout=True, deploy_avoided=False,
                          motivo_analise="acesso_site_servido")),
    "aguardando_criacao": ([execution(False, True), decision(True), "placeholder row found"], True,
                           dict(aguardando_criacao=True, manter_para_analise=False, bucket_name="",
                                motivo_analise="refresh_aguardando_apply")),
    "site_servido_nao_confiavel": ([execution(False, False, 1, "b-1"), decision(False, "other"),
                                    op("active_site_untrusted_access")], True,
                                   dict(active_site_untrusted_access=True, renovou_timeout=False,
                                        event_type="active_site_untrusted_access",
                                        motivo_analise="bot_ou_preview_em_ambiente_ativo")),
}


@pytest.mark.parametrize("state", CASES)
def test_states(spark, state):
    lines, http, expected = CASES[state]
    row = one(spark, "START RequestId: r", *lines, "END RequestId: r", http=http)
    assert row.estado_resposta == state
    assert {name: row[name] for name in expected} == expected


def test_columns(spark):
    row = one(spark, execution()).asDict()
    assert set(CLASSIFY_COLUMNS) <= set(row)
    assert not {"temp_item", "active_items", "ambiente_ativo"} & set(row)


def test_waiting_needs_http(spark):
    assert one(spark, execution(False, True), http=False).estado_resposta == "indefinido"


@pytest.mark.parametrize(
    "line,seen",
    [
        ('prefix 12:00 {"event": "deploy_triggered"}   ', True),
        ('{"event": "deploy_triggered"} tail', False),
        ('{"event": "deploy_triggered"}}', False),
        ('{"event": "deploy_triggered"', False),
        ('x } {"event": "deploy_triggered"}', True),
        ('{"\\u0065vent": "deploy_triggered"}', True),
        ('{"event": "deploy_triggered", "n": NaN}', True),
        ('[{"event": "deploy_triggered"}]', False),
        ('{"inner": {"event": "deploy_triggered"}}', False),
        ('a\x1e{"event": "deploy_triggered"}\x85b', True),
    ],
)
def test_strict_lines(spark, line, seen):
    assert one(spark, line).disparou_apply is seen


def test_last_event_of_a_name_wins(spark):
    assert one(spark, decision(False), decision(True)).status_confianca == "trusted"
    assert one(spark, '{"event": "access_decision", "trusted": false, "trusted": true}').status_confianca == "trusted"


@pytest.mark.parametrize(
    "value,expected",
    [("true", True), ("false", False), ('"false"', True), ('""', False), ("0", False), ("0.0", False), ("2", True),
     ("null", False), ("{}", False), ("[]", False), ("[0]", True)],
)
def test_truthiness(spark, value, expected):
    row = one(spark, '{"event": "lambda_execution", "origem_eventbridge": %s}' % value)
    assert row.origem_eventbridge is expected


@pytest.mark.parametrize("items,avoided", [("null", True), ("0", True), ("1", False), ('"2"', False), ("0.9", True)])
def test_active_items(spark, items, avoided):
    row = one(spark, '{"event": "lambda_execution", "active_items": %s}' % items, decision(False))
    assert row.deploy_avoided is avoided


def test_served_in_any_case_and_only_where_it_may_be_lowered(spark):
    texts = ["x Servindo site via proxy S3\ny", "SERVINDO SITE VIA PROXY s3", "servindo site via proxy s 3", "servindo site via proxy \u017f3", "SERV\u0130NDO site via proxy S3", "s3", ""]
    rows = spark.createDataFrame([(text,) for text in texts], "block_text string")
    text = F.col("block_text")
    found = rows.select(classify._served(text).alias("served"), F.lower(text).contains(classify.SITE_SERVED_TEXT).alias("lowered"))
    assert [row.served for row in found.collect()] == [row.lowered for row in found.collect()] == [True, True] + [False] * 5
    assert "CASE WHEN" in found.select("served")._jdf.queryExecution().executedPlan().toString()
