"""The whole calculation on random, skewed, NULL-ridden tables against SQL."""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest

from fieldfit.bindings.registry import plain
from fieldfit.bindings.sample import AS_OF, RULES
from fieldfit.bindings.views import compose
from fieldfit.operators.esn import esn_by_ticket, esn_validation
from fieldfit.plans import completeness as c

TABLES = {
    "v_lines": "associated_company_id string, ticket_associated_deal_id string, data_inicio_assinatura date, "
    "product_id string, fin__config_tipo string, quantidade_alterados bigint, mrr_total_produto double",
    "v_companies": "id string, razao_social string, endereco_uf string, status_da_empresa string, "
    "fleet_size_empresa bigint, potencial_total_da_empresa double, csm_name string",
    "v_assoc": "id string, grupo_economico_id string",
    "v_groups": "id string, grupo_economico__potencial_total double",
    "v_cube": "ticket_id string, company_id string, ticket_associated_deal_id string, pipeline_label string, "
    "ticket_status string, envio__classe string, instalacao__qtd_dispositivos_efetivamente_agendados bigint, "
    "instalacao__esns_processados array<string>",
    "v_deliveries": "ticket_id_crm string, esn string, unit_id string, sku string, modelo_item string, "
    "item_name string, created_at timestamp_ntz",
    "v_devices": "esn string, unit_id string, ordem_de_servico string",
    "v_finished": "ordem_de_servico string, data_servico date",
}
SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]"}


def make(seed: int) -> dict[str, list[tuple]]:
    rng = random.Random(seed)

    def day(low=0, high=2400):
        return dt.date(1995, 1, 1) + dt.timedelta(days=rng.randint(low, high))

    def hot(prefix, n, share=0.35):
        """A key of which one value holds a third of all rows."""
        return f"{prefix}0" if rng.random() < share else f"{prefix}{rng.randint(1, n)}"

    def maybe(value, p=0.1):
        return None if rng.random() < p else value

    types = ["Primeira venda", "Primeira venda [Upsell]", "Upsell", "Troca", "Upgrade", "Downgrade", "Abandono total", "Outro"]
    companies = [
        (f"c{i}", f"Empresa {i}", "SP", rng.choice(["Onboarding", "Ongoing", "Ongoing", "Encerrado"]), i, maybe(rng.uniform(0, 100), 0.2), "x")
        for i in range(40)
    ]
    starts = {}
    lines = []
    for _ in range(900):
        deal = hot("d", 150, 0.05)
        start = rng.choice(starts.setdefault(deal, [day(), day(1800, 2500)]))
        lines.append((hot("c", 39), maybe(deal, 0.02), start, rng.choice(["1", "3", "8", "11", "2"]), rng.choice(types[:1] * 3 + types), rng.randint(-1, 4), float(rng.randint(1, 50))))
    # A NULL downgraded deal would empty everything; that case has its own test.
    lines = [x for x in lines if not (x[1] is None and x[3] == "11")]
    cube, deliveries = [], []
    for i in range(400):
        cube.append((f"E{i}", maybe(hot("c", 39)), maybe(hot("d", 150)), "Envios", rng.choice(["Envio Entregue", "Envio Cancelado"]), rng.choice(["Upsell", "Troca", "Primeira compra"]), None, None))
    for i in range(150):
        serials = maybe([maybe(hot("s", 200), 0.05) for _ in range(rng.randint(0, 4))])
        cube.append((f"S{i}", maybe(hot("c", 39)), maybe(hot("d", 150)), "Serviços", rng.choice(["Agendar instalação", "Aguardando tecnico instalar"]), None, rng.randint(0, 3), serials))
    for _ in range(1500):
        deliveries.append((hot("E", 420), maybe(hot("s", 180)), maybe(hot("u", 3)), rng.choice(["DEV1", "DEV2", "PAREM1", "PAPERCHAVIDE"]), rng.choice("AB"), rng.choice("XY"), maybe(dt.datetime.combine(day(0, 30), dt.time()))))
    devices = [(maybe(hot("s", 200)), maybe(hot("u", 3)), maybe(hot("o", 250), 0.3)) for _ in range(700)]
    finished = [(maybe(hot("o", 260)), maybe(day(), 0.2)) for _ in range(300)]
    return {
        "v_lines": lines,
        "v_companies": companies,
        "v_assoc": [(f"c{i}", maybe(f"g{rng.randint(0, 12)}", 0.3)) for i in range(40)],
        "v_groups": [(f"g{i}", maybe(rng.uniform(0, 120), 0.2)) for i in range(10)],
        "v_cube": cube,
        "v_deliveries": deliveries,
        "v_devices": devices,
        "v_finished": finished,
    }


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(request, spark):
    data = make(request.param)
    con = duckdb.connect()
    frames = {}
    for name, ddl in TABLES.items():
        fields = [f.strip().split(" ") for f in ddl.split(", ")]
        columns = ", ".join(f"{n} {SQL_TYPES.get(t, t.upper())}" for n, t in fields)
        con.execute(f"CREATE TABLE {name} ({columns})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(fields))})", data[name])
        frames[name] = spark.createDataFrame(data[name], ddl)
    return con, frames


def same(df, con, sql):
    got = plain(df)
    result = con.execute(compose(sql, frozenset(TABLES)))
    names = [d[0] for d in result.description]
    expected = pd.DataFrame(result.fetchall(), columns=names)[got.columns]
    ours = sorted(str(tuple(None if pd.isna(v) else v for v in r)) for r in got.collect())
    theirs = sorted(str(tuple(None if pd.isna(v) else (v.item() if hasattr(v, "item") else v) for v in r)) for r in expected.astype(object).itertuples(index=False))
    assert len(ours) == len(theirs)
    assert [a for a, b in zip(ours, theirs) if a != b][:3] == []
    return len(ours)


def warehouse(frames):
    return c.Warehouse(*[frames[n] for n in ("v_lines", "v_companies", "v_assoc", "v_groups", "v_cube", "v_deliveries", "v_devices", "v_finished")])


def test_metrics(case):
    con, frames = case
    out = c.deal_metrics(c.deal_base(warehouse(frames), AS_OF, RULES), RULES)
    cols = ["deal_id", "company_id", "data_inicio_assinatura", "grupo_economico_id", "time_segmento", "classe_deal", "qtd_completude", "qtd_instalada", "qtd_agendado", "elegivel", "dias_restantes_prazo"]
    assert same(out.select(*cols), con, f"SELECT {', '.join(cols)} FROM v_metrics") > 100


def test_published_deals(case):
    con, frames = case
    deals = c.completeness_by_deal(warehouse(frames), AS_OF, RULES)
    assert same(deals, con, "SELECT * FROM v_deals") > 20
    assert deals.count() == deals.select("deal_id").distinct().count()


def test_pairs_and_ticket_summary(case):
    con, frames = case
    pairs = esn_validation(frames["v_cube"], frames["v_deliveries"])
    sql = """SELECT ticket_id, esn, dono_ticket_id, dono_company_id, esn_status FROM v_pairs"""
    assert same(pairs.select("ticket_id", "esn", "dono_ticket_id", "dono_company_id", "esn_status"), con, sql) > 50
    counts = esn_by_ticket(pairs).select("ticket_id", "esn_divergente_count", "esn_sem_match_count")
    sql = """SELECT ticket_id, count(*) FILTER (esn_status = 'divergente') AS esn_divergente_count,
        count(*) FILTER (esn_status = 'sem_match') AS esn_sem_match_count FROM v_pairs GROUP BY ticket_id"""
    same(counts, con, sql)
