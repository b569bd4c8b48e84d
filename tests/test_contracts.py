import datetime as dt
from dataclasses import replace

import pytest

from fieldfit.config import DEFAULT_RULES
from fieldfit.operators import contracts as c
from fieldfit.operators.relational import where_in

LINES = (
    "associated_company_id string, ticket_associated_deal_id string, data_inicio_assinatura date, product_id string, "
    "fin__config_tipo string, quantidade_alterados bigint, mrr_total_produto double"
)
D1, D2, D3 = dt.date(2024, 2, 1), dt.date(2024, 3, 1), dt.date(2024, 4, 1)


@pytest.fixture()
def lines(frame):
    return frame(
        LINES,
        ("c1", "d1", D1, "1", "Primeira venda [Upsell]", 3, 10.0),
        ("c1", "d1", D1, "3", "Upsell", 2, 5.0),
        ("c1", "d1", D2, "1", "Upsell", 4, 1.0),
        ("c1", "d2", D1, "1", "Upsell", 1, 1.0),
        ("c1", "d2", D1, "1", "Troca", 1, 1.0),
        ("c1", "d3", D1, "1", "Troca", 7, 9.0),
        ("c1", "d3", D1, "1", "Downgrade", 7, 9.0),
        ("c1", "d4", D1, "2", "Upsell", 1, 1.0),
        ("c1", "d5", dt.date(2023, 12, 31), "1", "Upsell", 1, 1.0),
        ("c2", "d6", D1, "1", "Upsell", 1, 1.0),
        ("c1", "49744884273", D1, "1", "Upsell", 1, 1.0),
        ("c1", None, D1, "1", "Upsell", 1, 1.0),
        ("c1", "d7", D1, "1", "Upsell", 1, 1.0),
        ("c1", "d7", D1, "11", "Downgrade", 2, 1.0),
        ("c1", "d8", D1, "1", "Upsell", 1, 1.0),
        ("c1", "d8", D1, "11", "Downgrade", -2, 1.0),
        ("c1", "d9", D3, "1", "Abandono total", 1, 1.0),
    )


@pytest.fixture()
def companies(frame):
    schema = (
        "id string, razao_social string, endereco_uf string, status_da_empresa string, fleet_size_empresa bigint, "
        "potencial_total_da_empresa double, csm_name string"
    )
    return frame(
        schema, ("c1", "Um", "SP", "Ongoing", 5, 10.0, "x"), ("c2", "Dois", "RJ", "Encerrado", 5, 99.0, "x")
    )


def test_contract_rows(lines, companies, rows):
    out = rows(
        c.contracts(lines, companies, DEFAULT_RULES),
        "ticket_associated_deal_id",
        "data_inicio_assinatura",
        "qtd_contratada_venda",
        "mrr_total",
        "classe_deal",
        "grupo_deal",
    )
    assert out == [
        ("d1", D1, 5, 15.0, "Primeira venda, Upsell", "VENDA"),
        ("d1", D2, 4, 1.0, "Upsell", "VENDA"),
        ("d3", D1, 0, 0.0, "Downgrade, Troca", "TROCA"),
        ("d8", D1, 1, 1.0, "Upsell", "VENDA"),
    ]


def test_null_downgraded_deal_empties_the_contracts(lines, companies, frame):
    extra = frame(LINES, ("c1", None, D1, "12", "Downgrade", 1, 1.0))
    assert c.contracts(lines.unionByName(extra), companies, DEFAULT_RULES).count() == 0


def test_cutoff_and_deny_list_are_parameters(lines, rows):
    rules = replace(DEFAULT_RULES, signed_from=dt.date(2023, 1, 1), denied_deals=("d1",))
    deals = {r[0] for r in rows(c.contract_grain(lines, rules), "ticket_associated_deal_id")}
    assert "d5" in deals and "49744884273" in deals and "d1" not in deals


def test_first_sale_after_last_churn(frame, rows):
    df = frame(
        LINES,
        ("a", "1", D1, "1", "Primeira venda", 1, 1.0),
        ("a", "2", D2, "1", "Abandono total", 1, 1.0),
        ("a", "3", D2, "1", "Primeira venda", 1, 1.0),
        ("a", "4", D3, "1", "Primeira venda", 1, 1.0),
        ("b", "5", D2, "1", "Primeira venda [Upsell]", 1, 1.0),
        ("c", "6", D1, "1", "Primeira venda", 1, 1.0),
        ("c", "7", D2, "1", "Abandono total", 1, 1.0),
        (None, "8", D1, "1", "Primeira venda", 1, 1.0),
        (None, "9", D3, "1", "Abandono total", 1, 1.0),
    )
    assert rows(c.first_sale(df)) == [("a", D2), ("b", D2), (None, D1)]
    sales = where_in(df, "fin__config_tipo", ["Primeira venda", "Primeira venda [Upsell]"])
    since = c.since_last_churn(sales, c.last_churn(df))
    assert rows(since, "ticket_associated_deal_id") == [("3",), ("4",), ("5",), ("8",)]


def test_group_facts_use_active_members_with_a_sale(frame, rows, companies):
    assoc = frame("id string, grupo_economico_id string", ("c1", "g"), ("c2", "g"), ("c3", "h"))
    sales = frame("associated_company_id string, data_primeira_venda_atual date", ("c1", D2), ("c2", D1))
    groups = frame("id string, grupo_economico__potencial_total double", ("g", 70.0), ("g", 60.0))
    facts = c.group_facts(c.active_group_members(assoc, companies, sales), groups)
    assert rows(facts) == [("g", D2, 70.0)]


def test_dedupe_keeps_most_days_remaining(frame, rows):
    df = frame(
        "deal_id string, company_id string, dias_restantes_prazo int", ("1", "b", 5), ("1", "a", 5), ("1", "c", 4), ("2", "z", -1)
    )
    assert rows(c.dedupe_deals(df)) == [("1", "a", 5), ("2", "z", -1)]
