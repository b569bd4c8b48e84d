import datetime as dt

import pytest

from fieldfit.operators import esn

CUBE = (
    "ticket_id string, company_id string, pipeline_label string, ticket_status string, "
    "instalacao__esns_processados array<string>"
)
DELIVERIES = "ticket_id_crm string, esn string, modelo_item string, item_name string, created_at timestamp_ntz"
T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
SCOPE = ("Serviços", "Agendar instalação")


@pytest.fixture()
def cube(frame):
    return frame(
        CUBE,
        ("t1", "c1", *SCOPE, ["1", "2", "3", None, "1"]),
        ("t2", "c2", *SCOPE, []),
        ("t3", None, *SCOPE, ["1"]),
        ("t4", "c4", "Serviços", "Concluído", ["1"]),
        ("old", "c1", "Envios", "x", None),
        ("old2", "c9", "Envios", "x", None),
        ("two", "c1", "Envios", "x", None),
        ("two", "c5", "Envios", "x", None),
        ("none", None, "Envios", "x", None),
    )


@pytest.fixture()
def deliveries(frame):
    return frame(
        DELIVERIES,
        ("old2", "1", "m", "i", T1),
        ("old", "1", "m", "i", T2),
        ("old2", "2", "m", "i", T2),
        ("old", "2", "m", "i", T1),
        ("none", "3", "m", "i", T1),
        ("old", None, "m", "i", T2),
    )


def test_statuses(cube, deliveries, rows):
    out = rows(esn.esn_validation(cube, deliveries), "ticket_id", "esn", "dono_company_id", "esn_status")
    assert out == sorted(
        [
            ("t1", "1", "c1", "ok"),
            ("t1", "1", "c1", "ok"),
            ("t1", "2", "c9", "divergente"),
            ("t1", "3", None, "sem_match"),
            ("t1", None, None, "sem_match"),
        ],
        key=repr,
    )
    assert esn.esn_validation(cube, deliveries, unique=True).count() == 4


def test_owner_ticket_with_two_companies(cube, frame, rows):
    moved = frame(DELIVERIES, ("two", "1", "m", "i", T2))
    every = esn.esn_validation(cube, moved).filter("esn = '1'")
    assert set(rows(every, "esn_status")) == {("divergente",), ("ok",)}
    # a keyed snapshot gets one row: the expected company is among the owner's
    keyed = esn.esn_validation(cube, moved, unique=True).filter("esn = '1'")
    assert rows(keyed, "esn_status") == [("ok",)]


def test_same_instant_is_decided_by_the_ties(frame, rows):
    same = frame(DELIVERIES, ("a", "1", "m", "i", T1), ("b", "1", "m", "i", T1), ("z", "1", "m", "i", None))
    assert rows(esn.newest_delivery(same), "dono_ticket_id") == [("b",)]


def test_summary_and_ticket_view(cube, deliveries, rows):
    pairs = esn.esn_validation(cube, deliveries, unique=True)
    assert rows(esn.esn_summary(pairs)) == [("divergente", 1, 1), ("ok", 1, 1), ("sem_match", 2, 1)]
    row = esn.esn_by_ticket(pairs).first()
    assert (row.esn_divergente_count, row.esn_sem_match_count, row.esn_modelos_raw) == (1, 2, ["m"])
    assert [d.esn for d in row.esn_detalhe][-3:] == ["1", "2", "3"] and len(row.esn_detalhe) == 4


def test_ticket_view_without_models_has_null_list(cube, frame):
    pairs = esn.esn_validation(cube, frame(DELIVERIES, ("x", "77", "m", "i", T1)), unique=True)
    assert esn.esn_by_ticket(pairs).first().esn_modelos_raw is None
