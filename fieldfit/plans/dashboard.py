"""Dashboard table, its indicators, filters and priority lists."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldfit.config import (
    DAYS_LEFT_BUCKETS,
    GAP_TO_GRADE_3_BUCKETS,
    GAP_TO_TARGET_BUCKETS,
    GENERAL_MANAGER,
    MRR_PERCENTILES,
)
from fieldfit.functions import bucket, days_open, is_stale, risk_status
from fieldfit.operators.esn import esn_by_ticket
from fieldfit.operators.relational import drop_in, latest_per_key, ordered, search, sparse_left_join
from fieldfit.operators.tickets import field_main
from fieldfit.session import stored

COMPLETENESS_COLUMNS = {
    "time_segmento": "completude_time_segmento",
    "qtd_completude": "completude_qtd_completude",
    "qtd_instalada": "completude_qtd_instalada",
    "pct_completude": "completude_pct",
    "qtd_falta_meta_80": "completude_qtd_falta",
    "dentro_do_prazo": "completude_dentro_do_prazo",
    "nota_instalacao": "completude_nota_instalacao",
    "qtd_falta_nota_3": "completude_qtd_falta_nota_3",
    "dias_restantes_prazo": "completude_dias_restantes_prazo",
}
SEARCH_COLUMNS = ("display_name", "company_name", "ticket_id", "company_id", "id_grupo_economico")
SLICES = 256  # of the values inside percentile brackets
SCORE_COLUMNS = ("id_grupo_economico", "company_name", "basic_value_score", "instalation_completeness_grade", "mrr")
DASHBOARD_COLUMNS = (
    "ticket_id",
    "display_name",
    "subject_raw",
    "pipeline_stage_label",
    "in_agendar_instalacao",
    "classe_instalacao",
    "owner_name",
    "owner_hubspot_id",
    "owner_squad",
    "createdate",
    "synced_at",
    "dias_aberto",
    "esn_count",
    "hubspot_url",
    "company_id",
    "deal_id",
    *SCORE_COLUMNS,
    "mrr_status",
    "field_status",
    "prestador",
    "consultor",
    "data_agendada",
    "status_tratativa",
    "observacao",
    "tratativa_updated_at",
    *COMPLETENESS_COLUMNS.values(),
    "esn_divergente_count",
    "esn_sem_match_count",
    "esn_modelos_raw",
    "esn_detalhe",
)


def latest_note(checks: DataFrame) -> DataFrame:
    """Newest handling note per ticket; an undated note counts as newest."""
    ties = [F.desc("status_tratativa"), F.desc("observacao")]
    return latest_per_key(checks, ["ticket_id"], [F.desc_nulls_first("updated_at")], ties).select(
        "ticket_id", "status_tratativa", "observacao", F.col("updated_at").alias("tratativa_updated_at")
    )


def latest_score(scores: DataFrame) -> DataFrame:
    """Score row of the newest week per company."""
    return latest_per_key(scores, ["company_id"], [F.desc("event_week")], [F.desc("basic_value_score")])


def _joined(rows: DataFrame, sides: list[tuple[DataFrame, str]]) -> DataFrame:
    return reduce(lambda left, side: sparse_left_join(left, *side, ["ticket_id"]), sides, rows)


def _facts_by_ticket(rows: DataFrame, sides: list[tuple[DataFrame, str]]) -> DataFrame:
    """``_joined`` for rows that lie by ticket and stay there.

    The different keys of a ticket are joined without the rest of its row. What they
    find is listed per ticket, and each row takes the entries of its own keys.
    """
    if not sides:
        return rows
    keys = [key for _, key in sides]
    found = _joined(rows.select("ticket_id", *keys).distinct(), sides)
    facts = [c for c in found.columns if c not in ("ticket_id", *keys)]
    found = found.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in facts]))
    listed = found.groupBy("ticket_id").agg(F.collect_list(F.struct(*keys, *facts)).alias("_found"))
    own = F.filter("_found", lambda x: reduce(lambda a, b: a & b, [x[k].eqNullSafe(F.col(k)) for k in keys]))
    out = rows.join(listed, "ticket_id", "left").withColumn("_own", F.explode_outer(own))
    return out.select(*rows.columns, *[F.col("_own")[c].alias(c) for c in facts])


def dashboard(
    tickets: DataFrame,
    members: DataFrame,
    scores: DataFrame | None,
    field: DataFrame,
    completeness: DataFrame | None,
    pairs: DataFrame | None,
    checks: DataFrame | None,
    as_of: dt.datetime,
    risk_col: str = "completude_nota_instalacao",
    main_visit: str = "unsuffixed",
    bucketed: bool = True,
    names: DataFrame | None = None,
) -> DataFrame:
    """One row per ticket with squad, score, visit, completeness, serials and note.

    Ticket-keyed sides come first: where tickets, field visits, serial pairs and
    notes are tables bucketed by ticket (``sources.write_bucketed``), none of them
    is shuffled. Where they are not (``bucketed=False``) only the keys of a ticket pass
    the shuffles by company and deal, and what is found comes back to it. Owner, company
    and deal of a ticket may be NULL and are joined accordingly. Scores, completeness, pairs and checks have one row at most per ticket,
    so a caller that asks for none of their columns may leave them out: the same rows
    come without those columns. ``names`` (company_id, company_name) are for tickets built
    without them, one row per company.
    """
    squads = members.select(
        F.col("hubspot_owner_id").alias("owner_hubspot_id"), F.col("squad").alias("owner_squad")
    )
    visits = field_main(field, main_visit).select(
        "ticket_id", F.col("status").alias("field_status"), "prestador", "consultor", "data_agendada"
    )
    by_ticket = [visits]
    if pairs is not None:
        by_ticket.append(esn_by_ticket(pairs))
    if checks is not None:
        by_ticket.append(latest_note(checks))
    others = []
    of_company = [scores.select("company_id", *SCORE_COLUMNS)] if scores is not None else []
    if names is not None:
        of_company.append(names.select("company_id", F.col("company_name").alias("_name")))
    if of_company:
        others.append((reduce(lambda a, b: a.join(b, "company_id", "full_outer"), of_company), "company_id"))
    if completeness is not None:
        deals = completeness.select("deal_id", *[F.col(c).alias(n) for c, n in COMPLETENESS_COLUMNS.items()])
        others.append((deals, "deal_id"))

    def with_ticket_keyed(rows: DataFrame) -> DataFrame:
        return reduce(lambda left, side: left.join(side, "ticket_id", "left"), by_ticket, rows)

    if bucketed:
        out = _joined(with_ticket_keyed(tickets), [(squads, "owner_hubspot_id"), *others])
    else:
        out = _joined(tickets, [(squads, "owner_hubspot_id")])
        known = out.filter(F.col("ticket_id").isNotNull())
        unknown = _joined(out.filter(F.col("ticket_id").isNull()), others)
        out = with_ticket_keyed(_facts_by_ticket(known, others)).unionByName(unknown, allowMissingColumns=True)
    if names is not None:
        out = out.withColumn("display_name", F.coalesce("_name", "display_name"))
    if completeness is not None:
        out = out.withColumn("mrr_status", risk_status(F.col(risk_col)))
    out = out.withColumn("dias_aberto", days_open(F.col("createdate"), as_of))
    return out.select(*[c for c in DASHBOARD_COLUMNS if c in out.columns])


def drop_acked(dash: DataFrame, acks: DataFrame) -> DataFrame:
    """Without the tickets once marked as scheduled."""
    return drop_in(dash, acks, "ticket_id")


def dashboard_filter(
    dash: DataFrame, squad: str | None = None, owner: int | None = None, owner_name: str | None = None
) -> DataFrame:
    wanted = {"owner_squad": squad, "owner_hubspot_id": owner, "owner_name": owner_name}
    for col, value in wanted.items():
        if value is not None:
            dash = dash.filter(F.col(col) == value)
    return dash


def search_dashboard(dash: DataFrame, term: str) -> DataFrame:
    """Text search over customer, company, ticket and economic group."""
    return search(dash, term, SEARCH_COLUMNS)


def sort_dashboard(dash: DataFrame, by: str, descending: bool = True) -> DataFrame:
    """Order with the ticket as tie-break, so equal values split over ranges."""
    first = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    return ordered(dash, [first, F.asc("ticket_id")])


def stale_badge(dash: DataFrame, as_of: dt.datetime, days: int = 2) -> DataFrame:
    return dash.withColumn("sync_desatualizado", is_stale(F.col("synced_at"), as_of, days))


def covering(dash: DataFrame, viewer_squad: str | None, viewer_role: str) -> DataFrame:
    """Whether the ticket's squad is another than the viewer's own."""
    if viewer_role == GENERAL_MANAGER or viewer_squad is None:
        return dash.withColumn("cobrindo", F.lit(False))
    other = F.coalesce(F.col("owner_squad") != viewer_squad, F.lit(False))
    return dash.withColumn("cobrindo", other)


def grade_distribution(dash: DataFrame, grade_col: str = "instalation_completeness_grade") -> DataFrame:
    """Distinct companies per grade."""
    per_company = (
        dash.filter(F.col("company_id").isNotNull()).groupBy("company_id").agg(F.max(grade_col).alias("grade"))
    )
    return per_company.groupBy("grade").agg(F.count(F.lit(1)).alias("company_count"))


def kpis(dash: DataFrame) -> DataFrame:
    """Open tickets, companies with revenue at risk, mean days open."""
    per_company = dash.groupBy("company_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.col("mrr_status") == "em_risco").alias("at_risk"),
        F.sum("dias_aberto").alias("days"),
        F.count("dias_aberto").alias("dated"),
    )
    return per_company.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tickets_abertos"),
        F.count_if(F.col("at_risk") & F.col("company_id").isNotNull()).alias("empresas_em_risco"),
        F.try_divide(F.sum("days"), F.sum("dated")).alias("media_dias_aberto"),
    )


def percentile_values(
    df: DataFrame, col: str, percentiles=MRR_PERCENTILES, accuracy: int = 100_000
) -> DataFrame:
    """Exact interpolated percentiles without sorting all values in one task.

    A sketch first brackets every percentile. One more pass counts the values
    between brackets as totals and keeps single values only inside a bracket: a
    few times rows / accuracy distinct values. A second sketch cuts those into
    slices; totals per slice, a bounded number, give the count before each slice,
    and running counts are taken inside the slices only. The counts are stored, so
    the input is read twice and no more.
    """
    values = df.filter(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("v"))
    margin = 5.0 / accuracy
    cuts = sorted({min(max(p + d, 0.0), 1.0) for p in percentiles for d in (-margin, margin)})
    sketch = values.agg(F.percentile_approx("v", [float(c) for c in cuts], accuracy)).scalar()
    position = {c: i for i, c in enumerate(cuts)}
    bounded = values.withColumn("cuts", sketch)
    inside = reduce(
        lambda a, b: a | b,
        [
            F.col("v").between(
                F.col("cuts")[position[max(p - margin, 0.0)]], F.col("cuts")[position[min(p + margin, 1.0)]]
            )
            for p in percentiles
        ],
    )
    below = F.size(F.filter("cuts", lambda c: c < F.col("v")))
    counted = stored(
        bounded.groupBy(below.alias("zone"), F.when(inside, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n")),
        "value-counts",
    )
    inner = counted.agg(F.percentile_approx("v", [i / SLICES for i in range(1, SLICES)], 10 * SLICES)).scalar()
    sliced = counted.withColumn("inner", inner).select(
        "zone",
        F.when(F.col("v").isNull(), -1).otherwise(F.size(F.filter("inner", lambda c: c < F.col("v")))).alias("slice"),
        "v",
        "n",
    )
    totals = sliced.groupBy("zone", "slice").agg(F.sum("n").alias("m"))  # zones times slices at most
    starts = totals.select("zone", "slice", (F.sum("m").over(Window.orderBy("zone", "slice")) - F.col("m")).alias("start"))
    so_far = Window.partitionBy("zone", "slice").orderBy("v")
    ranks = sliced.join(starts, ["zone", "slice"]).select(
        "v",
        "n",
        (F.col("start") + F.sum("n").over(so_far)).alias("upto"),
        totals.agg(F.sum("m")).scalar().alias("total"),
    )
    # After the window: it must not see a row once per percentile.
    ranks = ranks.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in percentiles])))
    at = F.col("p") * (F.col("total") - 1)
    low, high = F.floor(at), F.ceil(at)

    def value_at(rank):
        # The row whose running count first passes the rank holds its value.
        return F.max(F.when((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank), F.col("v")))

    picked = ranks.groupBy("p").agg(
        value_at(low).alias("lo"), value_at(high).alias("hi"), F.max(at - low).alias("share")
    )
    checked = F.when(
        F.col("lo").isNull() | F.col("hi").isNull(),
        F.raise_error(F.lit("percentile outside its bracket; raise the accuracy")).cast("double"),
    ).otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("share"))
    return picked.select("p", checked.alias("value"))


def mrr_thresholds(dash: DataFrame, percentiles=MRR_PERCENTILES) -> DataFrame:
    """Revenue percentiles offered as filter thresholds."""
    return percentile_values(dash, "mrr", percentiles)


def with_gap_buckets(dash: DataFrame) -> DataFrame:
    """Bucket labels of both gaps and of the days remaining."""
    return dash.withColumns(
        {
            "faixa_falta_meta": bucket(F.col("completude_qtd_falta"), GAP_TO_TARGET_BUCKETS),
            "faixa_falta_nota_3": bucket(F.col("completude_qtd_falta_nota_3"), GAP_TO_GRADE_3_BUCKETS),
            "faixa_dias": bucket(F.col("completude_dias_restantes_prazo"), DAYS_LEFT_BUCKETS),
        }
    )


def priority_completeness(dash: DataFrame, gap: str | None = "1-4", days: str | None = None) -> DataFrame:
    """In-time tickets of a gap bucket (and a days-left bucket), soonest first."""
    rows = with_gap_buckets(dash).filter("completude_dentro_do_prazo")
    if gap is not None:
        rows = rows.filter(F.col("faixa_falta_meta") == gap)
    if days is not None:
        rows = rows.filter(F.col("faixa_dias") == days)
    return sort_dashboard(rows, "completude_dias_restantes_prazo", descending=False)


def priority_score(dash: DataFrame, gap: str | None = "1-5", percentile: float | None = None) -> DataFrame:
    """Tickets of a gap-to-grade-3 bucket, optionally above a revenue percentile."""
    rows = with_gap_buckets(dash)
    if gap is not None:
        rows = rows.filter(F.col("faixa_falta_nota_3") == gap)
    if percentile is not None:
        limit = percentile_values(dash, "mrr", (percentile,)).select("value").scalar()
        rows = rows.filter(F.col("mrr") >= limit)
    return sort_dashboard(rows, "mrr")
