import pytest

from fieldfit.config import DEFAULT_RULES
from fieldfit.plans import completeness as c

METRICS = (
    "deal_id string, company_id string, qtd_completude bigint, qtd_instalada bigint, qtd_agendado bigint, "
    "elegivel boolean, dentro_do_prazo boolean"
)


@pytest.fixture()
def metrics(frame):
    return frame(
        METRICS,
        ("1", "a", 70, 3, 2, True, False),
        ("2", "a", 3, 1, 0, True, True),
        ("3", "a", 50, 50, 0, False, True),
        ("4", "b", 5, 5, 0, True, False),
        ("5", "c", 5, 5, 0, False, True),
        ("6", "d", 0, 0, 0, True, True),
    )


def test_company_rollup(metrics, rows):
    assert rows(c.completeness_by_company(metrics)) == [
        ("a", 73, 4, 0.0548, 55, True),
        ("b", 5, 5, 1.0, 0, False),
    ]


def test_company_totals_are_attached_to_every_deal(metrics, rows):
    out = c.with_company_totals(metrics)
    assert rows(out, "deal_id", "qtd_completude_empresa", "qtd_falta_meta_80_empresa") == [
        ("1", 73, 55),
        ("2", 73, 55),
        ("3", 73, 55),
        ("4", 5, 0),
        ("5", 0, 0),
        ("6", 0, 0),
    ]


def test_safe_ratios(metrics, rows):
    out = rows(c.completeness_measures(metrics, ["company_id"]))
    assert out[0] == ("a", 54 / 123, 56 / 123) and out[-1] == ("d", None, None)


def test_expired_modes(frame, rows):
    base = frame(
        "deal_id string, grupo_deal string, qtd_enviada bigint, qtd_contratada_venda bigint, qtd_instalada bigint, "
        "qtd_agendado bigint, time_segmento string, classe_deal string, dias_desde_assinatura int",
        ("1", "VENDA", 3, 10, 4, 7, "SMB", "Upsell", 60),
        ("2", "TROCA", 3, 0, 1, 0, "ICP", "Troca", 61),
        ("3", "VENDA", 3, 0, 1, 0, "Onboarding", "Primeira venda", 91),
    )
    flag = c.deal_metrics(base)
    assert rows(flag, "deal_id", "elegivel", "dentro_do_prazo", "dias_restantes_prazo") == [
        ("1", True, True, 0),
        ("2", True, False, -1),
        ("3", True, False, -1),
    ]
    assert rows(c.deal_metrics(base, DEFAULT_RULES, "drop"), "elegivel") == [(False,), (False,), (True,)]
    first = flag.filter("deal_id = '1'").first()
    assert (first.qtd_completude, first.qtd_pendente, first.pct_completude, first.pct_completude_com_agendado) == (10, 6, 0.4, 1.0)
    assert flag.filter("deal_id = '2'").first().qtd_completude == 3
    # A zero target gives ratio 1 and is removed by the positive-target filter.
    assert flag.filter("deal_id = '3'").first().pct_completude == 1.0
