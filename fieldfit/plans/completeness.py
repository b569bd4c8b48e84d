"""Installation completeness per deal and per company."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldfit.config import DEFAULT_RULES, CompletenessRules
from fieldfit.functions import (
    days_left,
    days_since,
    eligible,
    gap,
    grade,
    in_time,
    pct,
    pending,
    scale,
    segment,
    target_qty,
)
from fieldfit.functions.measures import ONBOARDING, grade_3_floor
from fieldfit.operators.contracts import (
    COMPANY,
    DEAL,
    REVENUE,
    START,
    compact_lines,
    company_facts,
    contract_grain,
    dedupe_deals,
    downgraded_deals,
)
from fieldfit.operators.relational import beside, outside, sparse_left_join
from fieldfit.operators.shipments import (
    dedupe_shipments,
    device_service,
    installed_since,
    installs_by_deal,
    scheduled,
    serial_service,
    shipments,
)
from fieldfit.schemas import INPUTS
from fieldfit.session import stored
from fieldfit.sources.tables import load_table

PUBLISHED = (
    "deal_id",
    "company_id",
    "time_segmento",
    "qtd_completude",
    "qtd_instalada",
    "pct_completude",
    "qtd_falta_meta_80",
    "dentro_do_prazo",
    "dias_restantes_prazo",
    "nota_instalacao",
    "qtd_falta_nota_3",
)


@dataclass(frozen=True)
class Warehouse:
    """The input tables of the completeness calculation."""

    lines: DataFrame
    companies: DataFrame
    associations: DataFrame
    groups: DataFrame
    tickets: DataFrame
    deliveries: DataFrame
    devices: DataFrame
    finished: DataFrame

    @classmethod
    def load(
        cls, spark: SparkSession, root: str | None, names: dict[str, str] | None = None, columns: dict | None = None
    ) -> Warehouse:
        """The eight tables as declared in ``schemas.INPUTS``, faults raised before anything runs.

        ``names`` maps a field of this class to the stored table where they differ,
        ``columns`` to its column renames (see ``load_table``).
        """
        names, columns = names or {}, columns or {}
        inputs = {f.name: INPUTS["cube" if f.name == "tickets" else f.name] for f in fields(cls)}
        return cls(
            **{
                name: load_table(spark, root, names.get(name, name), columns.get(name), schema=schema)
                for name, schema in inputs.items()
            }
        )


def deal_base(w: Warehouse, as_of: dt.date, rules: CompletenessRules = DEFAULT_RULES) -> DataFrame:
    """Contract rows with company, group, shipment, install and schedule facts.

    Every branch is aggregated to its own key before it is joined; no distinct
    count over a joined fan-out is needed. The contract lines are scanned once: what
    the branches need of them is stored per contract, type and product class, as
    are the facts per company and the contract rows. Only shipments of these rows'
    deals are followed, found on the tickets, before their deliveries are joined. All
    facts per deal, the mark of a downgraded deal included, meet in one table, so the
    contract rows are shuffled by deal once.
    """
    lines = stored(compact_lines(w.lines.drop(REVENUE), rules), "contract-lines")
    facts = stored(company_facts(lines, w.companies, w.associations, w.groups), "company-facts")
    downgraded = stored(downgraded_deals(lines, rules), "downgraded-deals")
    contracted = stored(contract_grain(lines, rules).join(facts, COMPANY), "contract-rows")
    serials = serial_service(
        dedupe_shipments(shipments(w.tickets, w.deliveries, contracted)), device_service(w.devices, w.finished)
    )
    marked = downgraded.filter(F.col(DEAL).isNotNull()).withColumn("_downgraded", F.lit(True))
    per_deal = installs_by_deal(serials).join(scheduled(w.tickets), DEAL, "full_outer").join(marked, DEAL, "full_outer")
    rows = sparse_left_join(contracted, per_deal, DEAL, [COMPANY, START])
    rows = rows.filter(outside(downgraded, DEAL, "_downgraded"))
    first_sale_day = F.coalesce("grupo_data_primeira_venda", "data_primeira_venda_atual")
    potential = F.coalesce("grupo_potencial", "potencial_total_da_empresa")
    return (
        rows.withColumns(
            {
                "qtd_enviada": F.coalesce("qtd_enviada", F.lit(0)),
                "qtd_instalada": F.coalesce(installed_since(F.col(START)), F.lit(0)),
                "qtd_agendado": F.coalesce("qtd_agendado", F.lit(0)),
                "dias_desde_assinatura": days_since(F.col(START), as_of),
                "dias_1a_venda_grupo": days_since(first_sale_day, as_of),
                "potencial": potential,
            }
        )
        .withColumn("time_segmento", segment(F.col("dias_1a_venda_grupo"), F.col("potencial"), rules))
        .withColumnsRenamed({DEAL: "deal_id", COMPANY: "company_id"})
        .drop("service_days", "undated_installs", "_downgraded")
    )


def deal_metrics(base: DataFrame, rules: CompletenessRules = DEFAULT_RULES, expired: str = "flag") -> DataFrame:
    """Target, pending, ratios, eligibility and deadline of each deal row.

    ``expired="flag"`` keeps deals past their deadline eligible;
    ``expired="drop"`` makes the deadline part of the eligibility.
    """
    seg, signed = F.col("time_segmento"), F.col("dias_desde_assinatura")
    installed, with_booked = F.col("qtd_instalada"), F.col("qtd_instalada_mais_agendado")
    target = F.col("qtd_completude")
    fits = eligible(seg, F.col("classe_deal"))
    if expired == "drop":
        fits = fits & in_time(seg, signed, rules)
    return (
        base.withColumn(
            "qtd_completude",
            target_qty(F.col("grupo_deal"), F.col("qtd_enviada"), F.col("qtd_contratada_venda")),
        )
        .withColumn("qtd_instalada_mais_agendado", installed + F.col("qtd_agendado"))
        .withColumns(
            {
                "qtd_pendente": pending(target, installed),
                "pct_completude": pct(installed, target),
                "pct_completude_com_agendado": pct(with_booked, target),
                "elegivel": fits,
                "dentro_do_prazo": in_time(seg, signed, rules),
                "dias_restantes_prazo": days_left(seg, signed, rules),
            }
        )
    )


def graded_deals(metrics: DataFrame, rules: CompletenessRules = DEFAULT_RULES) -> DataFrame:
    """Eligible deals with a positive target, graded 0-4, with both gaps."""
    target, installed = F.col("qtd_completude"), F.col("qtd_instalada")
    return (
        metrics.filter("elegivel and qtd_completude > 0")
        .withColumn("escala_nota", scale(F.col("time_segmento"), F.col("potencial"), rules))
        .withColumns(
            {
                "nota_instalacao": grade(F.col("pct_completude"), F.col("escala_nota"), rules),
                "qtd_falta_meta_80": gap(rules.target_share, target, installed),
                "qtd_falta_nota_3": gap(grade_3_floor(F.col("escala_nota"), rules), target, installed),
            }
        )
    )


def to_published(graded: DataFrame) -> DataFrame:
    whole = {"qtd_completude", "qtd_instalada", "qtd_falta_meta_80", "dias_restantes_prazo", "nota_instalacao", "qtd_falta_nota_3"}
    return graded.select(*[F.col(c).cast("int").alias(c) if c in whole else F.col(c) for c in PUBLISHED])


def completeness_by_deal(
    w: Warehouse, as_of: dt.date, rules: CompletenessRules = DEFAULT_RULES
) -> DataFrame:
    """The published result: one row per eligible deal."""
    metrics = deal_metrics(deal_base(w, as_of, rules), rules)
    return dedupe_deals(to_published(graded_deals(metrics, rules)))


def company_totals(metrics: DataFrame) -> DataFrame:
    """Per company: sums over its eligible deal rows, and any deal in time.

    Aggregated instead of a window, so that a company holding a large share of
    the deals is reduced in every task before the shuffle, and beside the
    company, so that a join on it can be split.
    """
    fits = F.col("elegivel")
    return metrics.groupBy("company_id", beside("company_id").alias("_beside")).agg(
        F.sum(F.when(fits, F.col("qtd_completude")).otherwise(0)).alias("qtd_completude_empresa"),
        F.sum(F.when(fits, F.col("qtd_instalada")).otherwise(0)).alias("qtd_instalada_empresa"),
        F.max(F.coalesce(fits & F.col("dentro_do_prazo"), F.lit(False))).alias("dentro_do_prazo"),
    ).drop("_beside")


def completeness_by_company(metrics: DataFrame, rules: CompletenessRules = DEFAULT_RULES) -> DataFrame:
    """Company roll-up with ratio (4 places) and gap; companies with a target only."""
    target, installed = F.col("qtd_completude_empresa"), F.col("qtd_instalada_empresa")
    return (
        company_totals(metrics)
        .filter("qtd_completude_empresa > 0")
        .select(
            "company_id",
            "qtd_completude_empresa",
            "qtd_instalada_empresa",
            pct(installed, target, 4).alias("pct_completude"),
            gap(rules.target_share, target, installed).alias("qtd_falta_meta_80"),
            "dentro_do_prazo",
        )
    )


def with_company_totals(metrics: DataFrame, rules: CompletenessRules = DEFAULT_RULES) -> DataFrame:
    """Each deal row with its company's totals, ratio and gap.

    The input is read twice; pass a checkpointed or stored frame.
    """
    target, installed = F.col("qtd_completude_empresa"), F.col("qtd_instalada_empresa")
    totals = company_totals(metrics).drop("dentro_do_prazo")
    return metrics.join(totals, "company_id").withColumns(
        {
            "pct_completude_empresa": pct(installed, target, 4),
            "qtd_falta_meta_80_empresa": gap(rules.target_share, target, installed),
        }
    )


ONBOARDING_COLUMNS = (
    "deal_id",
    "razao_social",
    "company_id",
    "status_da_empresa",
    "fleet_size_empresa",
    "potencial_total_da_empresa",
    START,
    "dias_desde_assinatura",
    "classe_deal",
    "time_segmento",
    "qtd_completude",
    "qtd_instalada",
    "qtd_agendado",
    "qtd_pendente",
    "qtd_completude_empresa",
    "qtd_instalada_empresa",
    "pct_completude_empresa",
    "qtd_falta_meta_80_empresa",
)


def completeness_measures(df: DataFrame, keys) -> DataFrame:
    """Safe ratios of sums per key combination, without and with booked units."""
    installed, booked, target = F.sum("qtd_instalada"), F.sum("qtd_agendado"), F.sum("qtd_completude")
    # Keys may be the summed columns themselves; the sums then run over duplicates.
    return df.groupBy(*keys).agg(
        F.try_divide(installed, target).cast("double").alias("pct_de_completude"),
        F.try_divide(installed + booked, target).cast("double").alias("pct_de_completude_agendado"),
    )


def onboarding_measures(metrics: DataFrame, rules: CompletenessRules = DEFAULT_RULES) -> DataFrame:
    """Deal-level report of the onboarding segment with company totals."""
    rows = with_company_totals(metrics, rules).filter(F.col("time_segmento") == ONBOARDING)
    return completeness_measures(rows, ONBOARDING_COLUMNS)
