"""Schemas of the sync payload and of the snapshot tables it maintains."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, BOOL, DATE, TIME = T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampType()


def columns(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


TICKETS = columns(
    ticket_id=TEXT,
    subject_raw=TEXT,
    display_name=TEXT,
    pipeline_stage_id=TEXT,
    pipeline_stage_label=TEXT,
    classe_instalacao=TEXT,
    owner_hubspot_id=LONG,
    owner_name=TEXT,
    company_id=TEXT,
    createdate=TIME,
    esn_count=INT,
    esn_list=T.ArrayType(TEXT),
    hubspot_url=TEXT,
    in_agendar_instalacao=BOOL,
)
TICKET_DEAL_IDS = columns(ticket_id=TEXT, deal_id=TEXT)
BASIC_VALUE = columns(
    company_id=TEXT,
    id_grupo_economico=TEXT,
    company_name=TEXT,
    event_week=DATE,
    basic_value_score=DOUBLE,
    instalation_completeness_grade=INT,
    mrr=DOUBLE,
    csm=TEXT,
)
FIELD_STATUS = columns(
    ordem_servico_raw=TEXT,
    ticket_id=TEXT,
    suffix_num=INT,
    status=TEXT,
    prestador=TEXT,
    consultor=TEXT,
    data_agendada=DATE,
    cliente=TEXT,
)
COMPLETENESS = columns(
    deal_id=TEXT,
    company_id=TEXT,
    time_segmento=TEXT,
    qtd_completude=INT,
    qtd_instalada=INT,
    pct_completude=DOUBLE,
    qtd_falta_meta_80=INT,
    dentro_do_prazo=BOOL,
    dias_restantes_prazo=INT,
    nota_instalacao=INT,
    qtd_falta_nota_3=INT,
)
ESN_PAIRS = columns(
    ticket_id=TEXT,
    esn=TEXT,
    company_id_esperado=TEXT,
    modelo_item=TEXT,
    item_name=TEXT,
    dono_ticket_id=TEXT,
    dono_company_id=TEXT,
    esn_status=TEXT,
)
TICKET_PRODUCTS = columns(ticket_id=TEXT, product_label=TEXT, quantity=LONG)
OWNER_UPDATES = columns(email=TEXT, hubspot_owner_id=LONG)

# Payload key -> schema of its rows.
PAYLOAD = {
    "tickets": TICKETS,
    "basic_value": BASIC_VALUE,
    "ticket_products": TICKET_PRODUCTS,
    "field_status": FIELD_STATUS,
    "team_members_updates": OWNER_UPDATES,
    "completude_instalacao": COMPLETENESS,
    "esn_validacao": ESN_PAIRS,
    "ticket_deal_ids": TICKET_DEAL_IDS,
}


def with_sync_time(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("synced_at", TIME)])


# Snapshot table -> schema of its rows.
SNAPSHOTS = {
    "tickets_sync": with_sync_time(T.StructType([*TICKETS.fields, T.StructField("deal_id", TEXT)])),
    "basic_value_snapshot": with_sync_time(BASIC_VALUE),
    "field_status_snapshot": with_sync_time(FIELD_STATUS),
    "completude_instalacao_snapshot": with_sync_time(COMPLETENESS),
    "esn_validacao_snapshot": with_sync_time(ESN_PAIRS),
    "ticket_products": TICKET_PRODUCTS,
    "team_members": columns(email=TEXT, name=TEXT, squad=TEXT, role=TEXT, active=BOOL, hubspot_owner_id=LONG),
    "bv_grade_snapshots": columns(snapshot_date=DATE, grade=TEXT, company_count=LONG, total_companies=LONG),
}


# Input table -> columns that the library reads, under its own names.
MONEY, TEXTS = T.DecimalType(38, 6), T.ArrayType(TEXT)
INPUTS = {
    "lines": columns(
        ticket_associated_deal_id=TEXT,
        associated_company_id=TEXT,
        data_inicio_assinatura=DATE,
        product_id=TEXT,
        quantidade_alterados=LONG,
        mrr_total_produto=MONEY,
        fin__config_tipo=TEXT,
    ),
    "companies": columns(
        id=TEXT,
        razao_social=TEXT,
        endereco_uf=TEXT,
        status_da_empresa=TEXT,
        fleet_size_empresa=LONG,
        potencial_total_da_empresa=DOUBLE,
        csm_name=TEXT,
    ),
    "associations": columns(id=TEXT, grupo_economico_id=TEXT),
    "groups": columns(id=TEXT, grupo_economico__potencial_total=DOUBLE),
    "cube": columns(
        ticket_id=TEXT,
        company_id=TEXT,
        ticket_associated_deal_id=TEXT,
        pipeline_label=TEXT,
        ticket_status=TEXT,
        envio__classe=TEXT,
        instalacao__qtd_dispositivos_efetivamente_agendados=LONG,
        instalacao__esns_processados=TEXTS,
    ),
    "deliveries": columns(
        ticket_id_crm=TEXT,
        esn=TEXT,
        unit_id=TEXT,
        sku=TEXT,
        modelo_item=TEXT,
        item_name=TEXT,
        created_at=TIME,
    ),
    "devices": columns(esn=TEXT, unit_id=TEXT, ordem_de_servico=TEXT),
    "finished": columns(ordem_de_servico=TEXT, data_servico=DATE),
    "scores": columns(
        company_id=TEXT,
        id_grupo_economico=TEXT,
        company_name=TEXT,
        event_week=DATE,
        basic_value_score=DOUBLE,
        instalation_completeness_grade=LONG,
        mrr=DOUBLE,
    ),
    "field_events": columns(
        ordem_de_servico=TEXT,
        status=TEXT,
        prestador=TEXT,
        consultor=TEXT,
        data_agendada=TIME,
        cliente=TEXT,
    ),
}
