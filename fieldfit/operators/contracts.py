"""Contract grain, churn, first sale and economic-group facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldfit.config import (
    ACTIVE_STATUS,
    CHURN_TYPE,
    DOWNGRADE_TYPE,
    FIRST_SALE_LABEL,
    FIRST_SALE_TYPES,
    SALE_TYPES,
    SWAP_TYPES,
    CompletenessRules,
)
from fieldfit.operators.relational import (
    drop_denied,
    latest_per_key,
    not_in,
    signed_since,
    sparse_left_join,
    where_in,
)

COMPANY = "associated_company_id"
DEAL = "ticket_associated_deal_id"
START = "data_inicio_assinatura"
TYPE = "fin__config_tipo"
REVENUE = "mrr_total_produto"  # summed where the lines have it
COMPANY_COLUMNS = (
    "razao_social",
    "endereco_uf",
    "status_da_empresa",
    "fleet_size_empresa",
    "potencial_total_da_empresa",
    "csm_name",
)


def with_company(lines: DataFrame, companies: DataFrame, status=ACTIVE_STATUS) -> DataFrame:
    """Rows with their company's attributes, active companies only."""
    active = where_in(companies, "status_da_empresa", status)
    dim = active.select(F.col("id").alias(COMPANY), *[c for c in COMPANY_COLUMNS if c in companies.columns])
    return lines.join(dim, COMPANY)


def _product_class(rules: CompletenessRules):
    """One product id for all that the rules treat alike; NULL for those they do not name."""
    tracked, accessories = set(rules.product_ids), set(rules.accessory_product_ids)
    out = F.lit(None).cast("string")
    for ids in (tracked - accessories, accessories - tracked, tracked & accessories):
        if ids:
            out = F.when(F.col("product_id").isin(*sorted(ids)), min(ids)).otherwise(out)
    return out


def compact_lines(lines: DataFrame, rules: CompletenessRules) -> DataFrame:
    """Lines with their quantities summed per company, deal, start, type and product class.

    ``contract_grain``, ``downgraded_deals``, ``last_churn`` and ``first_sale`` give the
    same for these rows as for the lines themselves, so one scan of the lines, already
    reduced in its tasks, serves them all.
    """
    return (
        lines.filter(F.col(TYPE).isin(*SALE_TYPES, *SWAP_TYPES, CHURN_TYPE))
        .groupBy(COMPANY, DEAL, START, TYPE, _product_class(rules).alias("product_id"))
        .agg(*[F.sum(c).alias(c) for c in ("quantidade_alterados", REVENUE) if c in lines.columns])
    )


def downgraded_deals(lines: DataFrame, rules: CompletenessRules) -> DataFrame:
    """Deals whose net accessory downgrade is positive."""
    return (
        lines.filter(F.col("product_id").isin(*rules.accessory_product_ids) & (F.col(TYPE) == DOWNGRADE_TYPE))
        .groupBy(DEAL)
        .agg(F.sum("quantidade_alterados").alias("net"))
        .filter("net > 0")
        .select(DEAL)
    )


CLASS_LABELS = sorted({FIRST_SALE_LABEL, *SALE_TYPES, *SWAP_TYPES} - {t for t in FIRST_SALE_TYPES if t != FIRST_SALE_LABEL})
CLASS_BITS = {label: 1 << i for i, label in enumerate(CLASS_LABELS)}
SWAP_MASK = sum(CLASS_BITS[t] for t in SWAP_TYPES)


def _class_bit():
    """Bit of a line's class label; the first-sale types share one label."""
    bit = F.when(F.col(TYPE).isin(*FIRST_SALE_TYPES), CLASS_BITS[FIRST_SALE_LABEL])
    for label, value in CLASS_BITS.items():
        bit = bit.when(F.col(TYPE) == label, value)
    return bit


def _class_text(mask):
    """Sorted class labels of a bit mask, joined."""
    return F.concat_ws(", ", *[F.when(mask.bitwiseAND(bit) != 0, label) for label, bit in CLASS_BITS.items()])


def contract_grain(lines: DataFrame, rules: CompletenessRules) -> DataFrame:
    """Sums, class labels and group per (company, deal, start), pure groups only.

    Company attributes depend on the company, so they are joined after this
    aggregation: a company with very many lines is already reduced by then.
    The set of class labels is carried as a bit mask, which keeps the whole
    aggregation on fixed-width buffers (hash aggregation, no sort).
    """
    sale = F.col(TYPE).isin(*SALE_TYPES)
    wanted = lines.filter(
        F.col("product_id").isin(*rules.product_ids) & F.col(TYPE).isin(*SALE_TYPES, *SWAP_TYPES)
    )
    wanted = drop_denied(signed_since(wanted, rules.signed_from, START), DEAL, rules.denied_deals)
    mask = F.col("_classes")
    swaps = mask.bitwiseAND(SWAP_MASK)
    return (
        wanted.groupBy(COMPANY, DEAL, START)
        .agg(
            F.sum(F.when(sale, F.col("quantidade_alterados")).otherwise(0)).alias("qtd_contratada_venda"),
            *[F.sum(F.when(sale, F.col(REVENUE)).otherwise(0)).alias("mrr_total")] * (REVENUE in lines.columns),
            F.bit_or(_class_bit()).alias("_classes"),
        )
        .filter((swaps == 0) | (swaps == mask))
        .withColumn("classe_deal", _class_text(mask))
        .withColumn("grupo_deal", F.when(swaps == 0, "VENDA").otherwise("TROCA"))
        .drop("_classes")
    )


def contracts(lines: DataFrame, companies: DataFrame, rules: CompletenessRules) -> DataFrame:
    """Contract rows of active companies without the downgraded deals."""
    grain = with_company(contract_grain(lines, rules), companies)
    return not_in(grain, downgraded_deals(lines, rules), DEAL)


def last_churn(lines: DataFrame) -> DataFrame:
    return (
        lines.filter(F.col(TYPE) == CHURN_TYPE)
        .groupBy(COMPANY)
        .agg(F.max(F.col(START).cast("date")).alias("ultimo_churn"))
    )


def first_sale(lines: DataFrame) -> DataFrame:
    """First sale day on or after the last churn, per company, in one scan and one shuffle.

    Tasks reduce their lines to the different days of a company; the calendar
    bounds what is held per company, however many lines it has.
    """
    churned, day = F.col(TYPE) == CHURN_TYPE, F.col(START).cast("date")
    facts = (
        lines.filter(F.col(TYPE).isin(CHURN_TYPE, *FIRST_SALE_TYPES))
        .groupBy(COMPANY)
        .agg(F.max(F.when(churned, day)).alias("churn"), F.collect_set(F.when(~churned, day)).alias("days"))
    )
    # A NULL company meets no churn row in an equi-join.
    since = F.when(F.col(COMPANY).isNotNull(), F.col("churn"))
    current = F.filter("days", lambda d: since.isNull() | (d >= since))
    return facts.select(COMPANY, F.array_min(current).alias("data_primeira_venda_atual")).filter(
        F.col("data_primeira_venda_atual").isNotNull()
    )


def since_last_churn(sales: DataFrame, churn: DataFrame) -> DataFrame:
    """Sale rows on or after the company's last churn (all if it never churned)."""
    recent = F.col(START).cast("date") >= F.coalesce("ultimo_churn", F.lit("1900-01-01").cast("date"))
    return sparse_left_join(sales, churn, COMPANY, [START]).filter(recent)


def active_group_members(associations: DataFrame, companies: DataFrame, sales: DataFrame) -> DataFrame:
    """(company, group, first sale) of active companies having a first sale."""
    members = associations.select(F.col("id").alias(COMPANY), "grupo_economico_id")
    active = where_in(companies, "status_da_empresa", ACTIVE_STATUS).select(F.col("id").alias(COMPANY))
    return members.join(active, COMPANY).join(sales, COMPANY)


def group_facts(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Earliest first sale and potential per economic group."""
    potential = groups.groupBy(F.col("id").alias("grupo_economico_id")).agg(
        F.max("grupo_economico__potencial_total").alias("grupo_potencial")
    )
    return (
        members.groupBy("grupo_economico_id")
        .agg(F.min("data_primeira_venda_atual").alias("grupo_data_primeira_venda"))
        .join(potential, "grupo_economico_id", "left")
    )


def company_facts(
    lines: DataFrame, companies: DataFrame, associations: DataFrame, groups: DataFrame
) -> DataFrame:
    """Per active company: attributes, first sale, group and the group's facts.

    Everything known per company is gathered first, on company-sized data, so
    the contract rows need a single join by company. A group's facts come from the
    same rows: its members are the active companies with a first sale.
    """
    active = where_in(companies, "status_da_empresa", ACTIVE_STATUS)
    own = active.select(F.col("id").alias(COMPANY), *[c for c in COMPANY_COLUMNS if c in companies.columns])
    # Rows of a company lie together before repeated ones go, so the join needs no shuffle more.
    member_of = associations.select(F.col("id").alias(COMPANY), "grupo_economico_id").repartition(COMPANY).distinct()
    known = own.join(first_sale(lines), COMPANY, "left").join(member_of, COMPANY, "left")
    members = known.filter("grupo_economico_id is not null and data_primeira_venda_atual is not null")
    return sparse_left_join(known, group_facts(members, groups), "grupo_economico_id", [COMPANY])


def dedupe_deals(df: DataFrame) -> DataFrame:
    """One row per deal: the one with the most days remaining."""
    ties = [F.asc(c) for c in ("company_id", "qtd_completude", "qtd_instalada", "time_segmento") if c in df.columns]
    return latest_per_key(df, ["deal_id"], [F.desc("dias_restantes_prazo")], ties)
