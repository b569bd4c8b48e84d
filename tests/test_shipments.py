import datetime as dt

from fieldfit.operators import shipments as s

D1, D2 = dt.date(2024, 5, 1), dt.date(2024, 6, 1)
CUBE = (
    "ticket_id string, ticket_associated_deal_id string, pipeline_label string, ticket_status string, "
    "envio__classe string, instalacao__qtd_dispositivos_efetivamente_agendados bigint"
)


def test_shipment_rules(frame, rows):
    tickets = frame(
        CUBE,
        ("t1", "d1", "Envios", "Entregue", "Upsell", None),
        ("t2", "d1", "Envios", "Envio Retornado", "Upsell", None),
        ("t3", "d1", "Envios", "Entregue", "Teste", None),
        ("t4", "d1", "Serviços", "Entregue", "Upsell", None),
        ("t5", "d2", "Envios", None, "Upsell", None),
        ("t6", "d3", "Envios", "Entregue", "Troca", None),
    )
    items = [("t1", "1", "u", "X1"), ("t1", None, "u", "X1"), ("t1", "2", "u", "PAREM9"), ("t1", "3", "u", "PAPERCHAVIDE")]
    items += [("t1", "4", "u", None)] + [(f"t{i}", "9", "u", "X1") for i in range(2, 7)]
    deliveries = frame("ticket_id_crm string, esn string, unit_id string, sku string", *items)
    assert rows(s.shipments(tickets, deliveries)) == [("d1", "1", "u", "Upsell"), ("d3", "9", "u", "Troca")]
    assert rows(s.shipments(tickets, deliveries, frame("ticket_associated_deal_id string", ("d3",)))) == [
        ("d3", "9", "u", "Troca")
    ]


def test_smallest_class_then_unit(frame, rows):
    ships = frame(
        "ticket_associated_deal_id string, esn string, unit_id string, envio__classe string",
        ("d", "1", "b", "Troca"),
        ("d", "1", "c", "Primeira compra"),
        ("d", "1", "a", "Primeira compra"),
        ("e", "1", "z", "Upsell"),
    )
    assert rows(s.dedupe_shipments(ships)) == [("d", "1", "a", "Primeira compra"), ("e", "1", "z", "Upsell")]


def service_frame(frame):
    ships = frame(
        "ticket_associated_deal_id string, esn string, unit_id string, envio__classe string",
        *[("d", str(i), "u", "Upsell") for i in range(6)],
    )
    devices = frame(
        "esn string, unit_id string, ordem_de_servico string",
        ("0", "u", "o0"),
        ("1", "u", "o1"),
        ("1", "u", "o1b"),
        ("2", "u", None),
        ("3", "other", "o0"),
        ("4", "u", "missing"),
        ("4", "u", None),
    )
    finished = frame(
        "ordem_de_servico string, data_servico date", ("o0", D1), ("o1", D2), ("o1b", dt.date(2024, 1, 1)), ("o1b", None), (None, D1)
    )
    return s.serial_service(ships, s.device_service(devices, finished))


def test_first_service_and_orders(frame, rows):
    out = rows(service_frame(frame), "esn", "data_servico", "has_order")
    assert out == [
        ("0", D1, True),
        ("1", dt.date(2024, 1, 1), True),
        ("2", None, False),
        ("3", None, False),
        ("4", None, True),
        ("5", None, False),
    ]


def test_install_counts_agree_with_rows_per_start(frame, rows):
    serials = service_frame(frame)
    starts = frame(
        "ticket_associated_deal_id string, data_inicio_assinatura date", ("d", dt.date(2023, 1, 1)), ("d", D1), ("d", D2), ("x", D1)
    )
    by_row = s.first_installation(serials, starts).groupBy("data_inicio_assinatura").agg(
        {"status_instalacao": "count"}
    )
    assert [r[1] for r in rows(by_row)] == [6, 6, 6]
    installed = rows(
        s.first_installation(serials, starts).filter("status_instalacao = 'Instalado'").groupBy("data_inicio_assinatura").count()
    )
    counted = starts.join(s.installs_by_deal(serials), "ticket_associated_deal_id")
    got = rows(counted.select("data_inicio_assinatura", s.installed_since(counted.data_inicio_assinatura)))
    assert got == installed == [(dt.date(2023, 1, 1), 3), (D1, 2), (D2, 1)]
    assert {r[0] for r in rows(counted, "qtd_enviada")} == {6}


def test_scheduled(frame, rows):
    tickets = frame(
        CUBE,
        ("1", "d", "Serviços", "Aguardando tecnico instalar", None, 2),
        ("2", "d", "Serviços", "Aguardando tecnico instalar", None, 3),
        ("3", "d", "Serviços", "Agendar instalação", None, 9),
        ("4", "e", "Serviços", "Aguardando tecnico instalar", None, 0),
        ("5", "f", "Serviços", "Aguardando tecnico instalar", None, 1),
    )
    assert rows(s.scheduled(tickets)) == [("d", 5), ("f", 1)]
    assert rows(s.scheduled(tickets, frame("ticket_associated_deal_id string", ("f",)))) == [("f", 1)]
