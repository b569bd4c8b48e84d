"""Business rules as data: every list, date and threshold an operator uses."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

# Results depend on these exact ids, labels and codes.
TRACKED_PRODUCTS = ("1", "3", "4", "5", "6", "8", "31", "32")
ACCESSORY_PRODUCTS = ("11", "12")
FIRST_SALE_TYPES = ("Primeira venda", "Primeira venda [Upsell]")
SALE_TYPES = ("Primeira venda", "Primeira venda [Upsell]", "Upsell")
SWAP_TYPES = ("Troca", "Upgrade", "Downgrade")
DOWNGRADE_TYPE = "Downgrade"
CHURN_TYPE = "Abandono total"
FIRST_SALE_LABEL = "Primeira venda"
ACTIVE_STATUS = ("Onboarding", "Ongoing")
SHIPMENT_PIPELINE = "Envios"
SHIPMENT_CLASSES = ("Primeira compra", "Upsell", "Troca", "Upgrade", "Downgrade")
DEAD_SHIPMENT_STATUS = ("Envio Retornado", "Envio Cancelado")
ACCESSORY_SKU_PREFIXES = ("PAREM", "PAPNP", "PAPERCAMAUX", "PAPERCARTR")
ACCESSORY_SKUS = (
    "PAPERCAMAUXCD",
    "PAPERCHAVIDE",
    "PAPERCAMAUXCI",
    "PAPERCAMAUXCE",
    "PAPERCARTRFID125",
    "PAPERCARTRFID013",
)
SERVICE_PIPELINE = "Serviços"
SCHEDULED_STATUS = "Aguardando tecnico instalar"
TO_SCHEDULE_STATUS = "Agendar instalação"
CRM_PIPELINE_ID = "263640"
CRM_STAGE_ID = "263641"
CRM_STAGE_LABEL = "Agendar Instalação"
INSTALLED = "Instalado"
NOT_INSTALLED = "Não Instalado"
GENERAL_MANAGER = "gestor_geral"
SQUAD_MANAGER = "gestor_squad"
SQUADS = ("onboarding", "smb", "icp")
GRADE_LABELS = ("0", "1", "2", "3", "4")
NO_DATA = "sem_dado"
QUANTITY_PREFIX = "quantidade_instalacao_"
QUANTITY_EXCLUDED = "calculado"
DENIED_DEALS = (
    "49744884273", "51088242312", "47907249332", "48859405420", "47277935129", "47662541092",
    "42407795752", "45107932311", "44888228389", "45429497935", "43937770118", "44464602501",
    "44452441377", "43241121701", "43739885079", "43500752711", "43369126798", "42905777020",
    "42960493590", "42973395979", "42361744266", "41443159393", "42656861344", "39265106823",
    "42252841361", "37485349527", "38979039274", "38345043279", "40792938788", "40286190860",
    "40456321868", "40456958240", "39875827496", "39988437666", "39662004113", "39805446740",
    "38516913051", "39995177997", "39349114788", "39549001221", "39259367226", "39222010663",
    "38847489864", "39125272207", "38818313555", "38098101656", "36837414186", "38601810042",
    "38209661847", "38936059725", "38130885752", "37186994180", "36592098949", "37422858593",
    "34036042268", "34529402508", "36457948799", "35866597238", "36130815518", "35866578863",
    "41782178732", "37238171010", "23239760558", "35848395942", "32325265742", "32153016413",
    "33496397369", "31086285475", "32114247697", "32354980431", "32755187613", "43906314407",
    "45962242096", "41470917405", "43542950696", "43361550263", "34665962803", "40759227727",
    "39983789097", "37883716791", "38737085351", "37730717356", "36195598214", "35565036865",
    "35684308328", "35445368936", "33917360525", "29706676599", "53284608543", "55031387469",
    "57019209475", "53674920452", "53507571525", "54265019467", "52476103450", "55679598968",
    "54004500151", "58133846644", "53418667180", "58630502585", "57939185442", "58208287837",
    "55381767541", "57982450758", "56896681728", "51727021069", "59522731339",
)


@dataclass(frozen=True)
class GradeScale:
    """Upper bounds (in whole percent) of grades 1-3 and the floor of grade 3."""

    grade_1_max: int
    grade_2_max: int
    grade_3_max: int
    grade_3_floor: Decimal


@dataclass(frozen=True)
class CompletenessRules:
    """Rules of the installation-completeness calculation."""

    signed_from: dt.date = dt.date(2024, 1, 1)
    product_ids: tuple[str, ...] = TRACKED_PRODUCTS
    accessory_product_ids: tuple[str, ...] = ACCESSORY_PRODUCTS
    denied_deals: tuple[str, ...] = DENIED_DEALS
    onboarding_days: int = 90
    other_days: int = 60
    icp_potential_over: int = 50
    target_share: Decimal = Decimal("0.8")
    smb_scale: GradeScale = GradeScale(75, 89, 95, Decimal("0.90"))
    icp_scale: GradeScale = GradeScale(75, 79, 85, Decimal("0.80"))


DEFAULT_RULES = CompletenessRules()

# Gap-size filters of the two priority lists; None = open upper end.
GAP_TO_TARGET_BUCKETS = ((1, 4), (5, 10), (11, 15), (16, None))
GAP_TO_GRADE_3_BUCKETS = ((1, 5), (6, 10), (11, 15), (16, None))
# The number of days is only known to run "from 1 day to 31+ days"; inner
# bounds are a choice of this library.
DAYS_LEFT_BUCKETS = ((1, 7), (8, 15), (16, 30), (31, None))
MRR_PERCENTILES = (0.5, 0.75, 0.9)
MIN_PAYLOAD_ROWS = 50
STALE_AFTER_DAYS = 2
