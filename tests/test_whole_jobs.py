"""What registered queries leave out, write and shuffle: nothing that their job does not ask for."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from fieldfit.bindings import queries as q
from fieldfit.bindings import sample, views
from fieldfit.bindings.sample import RULES, Sample
from fieldfit.operators import contracts, esn
from fieldfit.plans import completeness, dashboard

SF = "/root/testdata/sf0.001"

LINES = (
    "associated_company_id string, ticket_associated_deal_id string, data_inicio_assinatura date, product_id string, "
    "fin__config_tipo string, quantidade_alterados bigint"
)


def test_no_deal_of_the_sample_is_denied(frame, rows):
    deals = ("1", "2", "3", "5", "8", "13", "21", "34", "55", "89", "90", "49744884273")
    lines = frame(LINES, *[("c", d, dt.date(1997, 1, 1), "1", "Upsell", 1) for d in deals])
    assert rows(contracts.contract_grain(lines, RULES), "ticket_associated_deal_id") == sorted((d,) for d in deals)
    assert not re.search(r"deal_id\s+NOT IN\s*\('", " ".join(views.VIEWS.values()))


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df) -> int:
    return len(re.findall(r"(?<!Reused)Exchange ", df._jdf.queryExecution().executedPlan().toString()))


def test_completeness_writes_no_copy_of_its_inputs(spark, monkeypatch):
    monkeypatch.setattr(sample, "KEPT", {})
    completeness.deal_base(Sample(spark, SF).warehouse(), sample.AS_OF, RULES)
    assert sample.KEPT == {}


def test_tickets_without_serials_read_no_deliveries_and_are_the_same(spark, rows):
    s = Sample(spark, SF)
    lean = s.cube(serials=False)
    assert rows(lean) == rows(s.cube(), *lean.columns)
    assert "l_partkey" not in lean._jdf.queryExecution().executedPlan().toString()


def test_lines_are_summed_where_they_were_joined(spark, no_broadcast):
    lines = Sample(spark, SF).lines().drop("mrr_total_produto")
    assert exchanges(contracts.compact_lines(lines, RULES)) == 2


def test_field_visits_are_ranked_and_laid_out_in_one_shuffle(spark, no_broadcast):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert exchanges(Sample(spark, SF).field().repartition(parts, "ticket_id")) == 1


def test_pairs_lie_by_ticket_already(spark, no_broadcast):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = Sample(spark, SF).pairs()
    assert exchanges(pairs.repartition(parts, "ticket_id")) == exchanges(pairs)


def test_graded_rows_are_stored_and_not_computed_twice(spark):
    out = q.reconciled_grades(Sample(spark, SF))
    assert "LogicalRDD" not in out._jdf.queryExecution().analyzed().toString()
    assert all("graded-deals" in path for path in out.inputFiles())


def test_queries_of_few_dashboard_columns_build_only_their_sides(spark, monkeypatch):
    monkeypatch.setattr(sample, "KEPT", {})
    for build in (q.group_search, q.indicators):
        text = build(Sample(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
        assert sample.KEPT == {} and "esn_status" not in text
    assert "qtd_completude" not in q.group_search(Sample(spark, SF))._jdf.queryExecution().analyzed().toString()


def test_fewer_sides_give_the_same_rows(spark, rows):
    s = Sample(spark, SF)
    whole = q.dash(s)
    for sides in ((), ("scores",), ("completeness",), ("pairs", "checks"), ("scores", "completeness", "pairs", "checks")):
        some = q.dash_with(s, *sides)
        assert rows(some) == rows(whole, *some.columns), sides
    assert some.columns == whole.columns


def test_field_visits_are_shuffled_as_lines_not_as_texts(spark):
    plan = Sample(spark, SF).field()._jdf.queryExecution().executedPlan().toString()
    assert "prestador " in plan and "prestador " not in plan.split("Exchange")[1]


def test_dashboard_table_writes_no_snapshot_and_moves_no_list_of_serials(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(sample, "KEPT", {})
    q.dashboard_table(Sample(spark, SF))
    assert sample.KEPT == {}


def test_owner_companies_are_looked_up_once_per_serial(spark, no_broadcast):
    s = Sample(spark, SF)
    plan = esn.esn_validation(s.cube(), s.deliveries())._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(dono_ticket_id", plan)) == 2
    assert not any("_spread" in line for line in plan.splitlines() if "Exchange hash" in line)


def test_serial_lists_of_both_ticket_tables_share_a_shuffle(spark, no_broadcast):
    s = Sample(spark, SF)
    both = s.crm().select("hs_object_id", "ops_owner").join(
        s.cube().select(F.col("ticket_id").alias("hs_object_id"), "instalacao__esns_processados"), "hs_object_id"
    )
    assert both.collect() and "ReusedExchange" in both._jdf.queryExecution().executedPlan().toString()


TICKET = (
    "ticket_id string, display_name string, subject_raw string, pipeline_stage_label string, in_agendar_instalacao boolean, "
    "classe_instalacao string, owner_name string, owner_hubspot_id bigint, createdate timestamp, synced_at timestamp, "
    "esn_count int, hubspot_url string, company_id string, deal_id string"
)


def test_tickets_without_id_or_repeated_keep_their_facts(frame, rows):
    day = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    ids = [("t1", "c1", "d1"), ("t1", "c1", "d1"), ("t1", "c2", "d2"), ("t1", None, "d1"), ("t2", "c2", None), ("t3", "x", "x")]
    ids += [(None, "c1", "d2"), (None, "c1", "d2"), (None, None, "d1"), (None, None, None)]
    tickets = frame(TICKET, *[(t, "n", "s", "l", True, "k", "o", 1, day, day, 1, None, c, d) for t, c, d in ids])
    members = frame("hubspot_owner_id bigint, squad string", (1, "smb"), (1, "icp"))
    scores = frame(
        "company_id string, id_grupo_economico string, company_name string, basic_value_score double, instalation_completeness_grade int, mrr double",
        ("c1", "g1", "Um", 1.5, 2, 10.0), ("c2", "g2", None, 2.5, 3, 20.0), (None, "g3", "no", 0.0, 0, 0.0),
    )
    visits = "ordem_servico_raw string, ticket_id string, suffix_num int, status string, prestador string, consultor string, data_agendada date"
    field = frame(visits, ("t1", "t1", None, "main", "p", "q", day.date()), (None, None, None, "none", "p", "q", day.date()))
    deals = frame(
        "deal_id string, time_segmento string, qtd_completude int, qtd_instalada int, pct_completude double, qtd_falta_meta_80 int, "
        "dentro_do_prazo boolean, nota_instalacao int, qtd_falta_nota_3 int, dias_restantes_prazo int",
        ("d1", "SMB", 10, 5, 0.5, 3, True, 1, 4, 6), ("d2", "ICP", 10, 9, 0.9, 0, False, 4, 0, -3),
    )
    pairs = frame("ticket_id string, esn string, modelo_item string, esn_status string, dono_ticket_id string, dono_company_id string", ("t1", "2", "B", "ok", "x", "y"))
    notes = frame("ticket_id string, status_tratativa string, observacao string, updated_at timestamp", ("t2", "s", "o", day), (None, "s", "o", day))
    made = [dashboard.dashboard(tickets, members, scores, field, deals, pairs, notes, day, bucketed=b) for b in (True, False)]
    assert made[0].columns == made[1].columns and rows(made[0]) == rows(made[1]) and len(rows(made[0])) == 2 * len(ids)
    assert sorted((r.id_grupo_economico, r.completude_nota_instalacao) for r in made[1].filter("ticket_id is null and company_id is not null").collect()) == [("g1", 4)] * 4


def test_company_names_are_looked_up_by_key(spark, rows):
    s = Sample(spark, SF)
    assert "event_type" not in s.tickets_sync(named=False)._jdf.queryExecution().optimizedPlan().toString()
    assert rows(q.dash_with(s), "ticket_id", "display_name") == rows(s.tickets_sync(), "ticket_id", "display_name")
