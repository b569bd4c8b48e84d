import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldfit.operators import evolution, reconcile, tickets, visibility
from fieldfit.plans import dashboard as d

NOW = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)
TS = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)


@pytest.fixture()
def board(frame):
    ticket = (
        "ticket_id string, display_name string, subject_raw string, pipeline_stage_label string, in_agendar_instalacao boolean, "
        "classe_instalacao string, owner_name string, owner_hubspot_id bigint, createdate timestamp, synced_at timestamp, "
        "esn_count int, hubspot_url string, company_id string, deal_id string"
    )
    fixed = ("n", "s", "l", True, "c", "o")
    rows = [
        ("t1", *fixed, 1, TS, TS, 1, None, "c1", "d1"),
        ("t2", *fixed, 9, TS, NOW, 1, None, "c1", "d2"),
        ("t3", *fixed, None, None, NOW, 1, None, None, None),
    ]
    members = frame("hubspot_owner_id bigint, squad string", (1, "smb"), (None, "icp"))
    scores = frame(
        "company_id string, id_grupo_economico string, company_name string, basic_value_score double, instalation_completeness_grade int, mrr double, event_week date",
        ("c1", "g", "Um", 1.5, 2, 10.0, dt.date(2024, 5, 6)),
        ("c1", "g", "Um", 1.0, 1, 9.0, dt.date(2024, 4, 29)),
    )
    field = frame(
        "ordem_servico_raw string, ticket_id string, suffix_num int, status string, prestador string, consultor string, data_agendada date",
        ("t1", "t1", None, "main", "p", "q", dt.date(2024, 5, 2)),
        ("t1-1", "t1", 1, "later", "p", "q", dt.date(2024, 5, 3)),
        ("t2-2", "t2", 2, "second", "p", "q", dt.date(2024, 5, 3)),
    )
    deals = frame(
        "deal_id string, time_segmento string, qtd_completude int, qtd_instalada int, pct_completude double, qtd_falta_meta_80 int, "
        "dentro_do_prazo boolean, nota_instalacao int, qtd_falta_nota_3 int, dias_restantes_prazo int",
        ("d1", "SMB", 10, 5, 0.5, 3, True, 1, 4, 6),
        ("d2", "ICP", 10, 9, 0.9, 0, False, 4, 0, -3),
    )
    pairs = frame(
        "ticket_id string, esn string, modelo_item string, esn_status string, dono_ticket_id string, dono_company_id string",
        ("t1", "2", "B", "divergente", "x", "y"),
        ("t1", "1", "A", "ok", "x", "y"),
    )
    notes = frame(
        "ticket_id string, status_tratativa string, observacao string, updated_at timestamp",
        ("t1", "old", "o", TS),
        ("t1", "new", "o", NOW),
        ("t2", "dated", "o", NOW),
        ("t2", "undated", "o", None),
        ("gone", "kept", "o", NOW),
    )
    return d.dashboard(frame(ticket, *rows), members, d.latest_score(scores), field, deals, pairs, notes, NOW)


def test_dashboard_rows(board):
    assert len(board.columns) == 42
    got = {r.ticket_id: r for r in board.collect()}
    assert len(got) == 3
    one, two, three = got["t1"], got["t2"], got["t3"]
    assert (one.owner_squad, one.mrr, one.field_status, one.completude_pct, one.mrr_status) == ("smb", 10.0, "main", 0.5, "em_risco")
    assert (one.dias_aberto, one.status_tratativa, one.esn_divergente_count) == (31.0, "new", 1)
    assert one.esn_modelos_raw == ["A", "B"] and [x.esn for x in one.esn_detalhe] == ["1", "2"]
    assert (two.owner_squad, two.field_status, two.mrr_status, two.status_tratativa) == (None, None, "ok", "undated")
    assert (three.owner_squad, three.mrr, three.mrr_status, three.dias_aberto) == (None, None, "ok", None)


def test_board_operators(board, frame, rows):
    assert rows(d.drop_acked(board, frame("ticket_id string", ("t1",), ("zz",))), "ticket_id") == [("t2",), ("t3",)]
    assert rows(d.dashboard_filter(board, squad="smb"), "ticket_id") == [("t1",)]
    assert rows(d.search_dashboard(board, "T3"), "ticket_id") == [("t3",)]
    assert d.search_dashboard(board, "c1").count() == 2
    assert rows(d.dashboard_filter(board, owner=9), "ticket_id") == [("t2",)]
    assert [r.ticket_id for r in d.sort_dashboard(board, "mrr").collect()] == ["t1", "t2", "t3"]
    assert rows(d.stale_badge(board, NOW), "ticket_id", "sync_desatualizado") == [("t1", True), ("t2", False), ("t3", False)]
    assert rows(d.covering(board, "icp", "colaborador"), "ticket_id", "cobrindo") == [("t1", True), ("t2", False), ("t3", False)]
    assert rows(d.covering(board, None, "gestor_geral"), "cobrindo") == [(False,)] * 3
    assert rows(d.grade_distribution(board)) == [(2, 1)]
    assert rows(d.kpis(board)) == [(3, 1, 31.0)]
    assert rows(d.priority_completeness(board, "1-4", "1-7"), "ticket_id") == [("t1",)]
    assert d.priority_completeness(board, "5-10").count() == 0
    assert rows(d.priority_score(board, "1-5", 0.5), "ticket_id") == [("t1",)]


@pytest.mark.parametrize("seed", range(6))
def test_percentiles_match_linear_interpolation(spark, seed):
    rng = random.Random(seed)
    n = [1, 2, 5, 400, 3000, 3000][seed]
    # A third of the values are one and the same.
    values = [7.0 if rng.random() < 0.35 else round(rng.uniform(-50, 50), 2) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "mrr double").repartition(4)
    accuracy = 50 if seed == 5 else 100_000
    got = {r.p: r.value for r in d.percentile_values(df, "mrr", (0.5, 0.75, 0.9), accuracy).collect()}
    values.sort()
    for p in (0.5, 0.75, 0.9):
        at = p * (n - 1)
        low = values[int(at)]
        high = values[min(int(at) + 1, n - 1)]
        assert got[p] == pytest.approx(low + (high - low) * (at - int(at)))


def test_percentiles_of_nothing(frame):
    assert d.percentile_values(frame("mrr double", (None,)), "mrr").count() == 0


def test_evolution_sums_to_the_company_count(frame, rows):
    weeks = [dt.date(2024, 1, 1), dt.date(2024, 1, 29), dt.date(2024, 2, 5)]
    scores = frame(
        "company_id string, event_week date, g int",
        ("a", weeks[0], 0),
        ("b", weeks[0], 4),
        ("a", weeks[1], None),
        ("b", weeks[1], 4),
        ("zz", weeks[1], 4),
        ("a", weeks[2], 1),
    )
    companies = frame("company_id string", ("a",), ("b",), ("c",), ("a",))
    weekly = evolution.grade_evolution(scores, companies, "g")
    assert weekly.count() == 18
    sums = weekly.groupBy("snapshot_date").agg(F.sum("company_count").alias("n"), F.max("total_companies").alias("t"))
    assert rows(sums, "n", "t") == [(3, 3)] * 3
    found = {(r.snapshot_date, r.grade): r.company_count for r in weekly.collect()}
    assert found[(weeks[1], "sem_dado")] == 2 and found[(weeks[1], "4")] == 1 and found[(weeks[0], "0")] == 1
    monthly = evolution.grade_evolution_monthly(weekly)
    assert monthly.count() == 12
    assert rows(monthly.filter("grade = '4'"), "month", "company_count") == [
        (dt.date(2024, 1, 1), 1),
        (dt.date(2024, 2, 1), 0),
    ]


def test_reconcile_shows_differences_and_missing_groups(frame, rows):
    a = frame("seg string, q int", ("x", 1), ("x", 2), (None, 5))
    b = frame("seg string, q int", ("x", 3), (None, 5), ("y", 1))
    out = reconcile.reconcile(a, b, ["seg"], ["q"])
    assert rows(out, "seg", "rows_diff", "q_diff", "agree") == [("x", 1, 0, False), ("y", -1, -1, False), (None, 0, 0, True)]


MEMBERS = "email string, squad string, role string, active boolean, hubspot_owner_id bigint"


@pytest.fixture()
def team(frame):
    return frame(
        MEMBERS,
        ("a@x", "smb", "colaborador", True, 1),
        ("b@x", "smb", "gestor_squad", True, 2),
        ("c@x", None, "gestor_geral", True, None),
        ("d@x", "icp", "colaborador", False, 4),
        ("e@x", "icp", "colaborador", True, 5),
    )


def test_visibility(team, frame, rows):
    all_tickets = frame(
        "ticket_id string, owner_hubspot_id bigint, company_id string, deal_id string",
        ("t1", 1, "c1", "d1"),
        ("t2", 2, "c2", None),
        ("t4", 4, "c1", "d4"),
        ("t5", 5, None, "d5"),
        ("tn", None, "c9", "d9"),
    )
    grants = frame("owner_email string, grantee_email string", ("e@x", "a@x"), ("a@x", "d@x"))

    def sees(viewer):
        return [r[0] for r in rows(visibility.visible_tickets(all_tickets, team, grants, viewer), "ticket_id")]

    assert sees("a@x") == ["t1", "t5"]
    assert sees("b@x") == ["t1", "t2"]
    assert sees("c@x") == ["t1", "t2", "t4", "t5", "tn"]
    assert sees("d@x") == [] and sees("nobody@x") == []
    mine = visibility.visible_tickets(all_tickets, team, grants, "a@x")
    companies = frame("company_id string", ("c1",), ("c2",), (None,))
    assert rows(visibility.visible_by(companies, mine, "company_id")) == [("c1",)]
    deals = frame("deal_id string", ("d1",), ("d5",), ("d9",), (None,))
    assert rows(visibility.visible_by(deals, mine, "deal_id")) == [("d1",), ("d5",)]
    assert visibility.visible_members(team, "a@x").count() == 5
    assert visibility.visible_members(team, "d@x").count() == 0


def test_ticket_table(frame, rows):
    raw = frame(
        "hs_object_id string, subject string, createdate timestamp, hs_pipeline string, hs_pipeline_stage string, ops__instalacao__esns string, "
        "ops__instalacao__classe string, ops_owner bigint, company_id string, deal_id string",
        ("1", "[SUPPLY | x] Instalação ACME Deal ID: 5", TS, "263640", "263641", "9,8", "Piloto", 7, None, "5"),
        ("2", "s", TS, "263640", "1", None, None, None, "c", None),
        ("3", "s", TS, "9", "263641", None, None, None, "c", None),
        ("4", "s", TS, None, None, None, None, 8, "c", None),
    )
    field = tickets.field_status(
        frame(
            "ordem_de_servico string, status string, prestador string, consultor string, data_agendada string, cliente string",
            ("2-1", "x", "p", None, "2024-01-02", "c"),
            ("2-2", "x", "p", None, "2024-01-02", "c"),
            ("4", "x", "p", None, None, "c"),
        )
    )
    names = frame("company_id string, company_name string", ("c", "Nome"))
    owners = frame("owner_hubspot_id bigint, owner_name string", (7, "Ana"))
    out = tickets.tickets(raw, field, names, owners, url_prefix="https://crm/")
    assert rows(out, "ticket_id", "display_name", "owner_name", "esn_count", "in_agendar_instalacao", "hubspot_url") == [
        ("1", "ACME", "Ana", 2, True, "https://crm/1"),
        ("2", "Nome", None, 0, False, "https://crm/2"),
        ("4", "Nome", None, 0, False, "https://crm/4"),
    ]
    assert rows(tickets.field_main(field), "ordem_servico_raw") == [("4",)]
    assert rows(tickets.field_main(field, "lowest"), "ordem_servico_raw") == [("2-1",), ("4",)]


def test_ticket_products_merge_labels(frame, rows):
    raw = frame(
        "ticket_id string, quantidade_instalacao_a string, quantidade_instalacao_b string, quantidade_instalacao_c string",
        ("1", "2", "3", "0"),
        ("2", None, None, "4"),
    )
    labels = frame(
        "property string, product_label string", ("quantidade_instalacao_a", "R"), ("quantidade_instalacao_b", "R")
    )
    assert rows(tickets.ticket_products(raw, labels)) == [("1", "R", 5), ("2", "quantidade_instalacao_c", 4)]
