"""Independent SQL over the sample tables, for checking the Spark results.

Each view is a plain query text; ``compose`` puts the ones a statement uses in
front of it.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

VIEWS["v_lines"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS ticket_associated_deal_id,
       CAST(o_custkey AS VARCHAR) AS associated_company_id,
       CAST(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN l_shipdate ELSE o_orderdate END AS DATE)
         AS data_inicio_assinatura,
       CASE l_linenumber WHEN 2 THEN '8' WHEN 7 THEN '11' ELSE CAST(l_linenumber AS VARCHAR) END AS product_id,
       CAST(ceil(l_quantity / 40) AS BIGINT) AS quantidade_alterados,
       CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS mrr_total_produto,
       CASE WHEN o_orderstatus = 'P' AND l_linenumber <= 3 THEN 'Abandono total'
            WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'Downgrade'
            WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Troca'
            WHEN l_returnflag = 'R' THEN 'Upgrade'
            WHEN l_returnflag = 'A' THEN 'Upsell'
            WHEN l_linestatus = 'O' THEN 'Primeira venda [Upsell]'
            ELSE 'Primeira venda' END AS fin__config_tipo
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

VIEWS["v_companies"] = """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS razao_social, CAST(c_nationkey AS VARCHAR) AS endereco_uf,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'Onboarding'
            WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'Ongoing' ELSE 'Encerrado' END AS status_da_empresa,
       CAST(c_nationkey * 10 AS BIGINT) AS fleet_size_empresa, c_acctbal / 100 AS potencial_total_da_empresa,
       'csm-' || c_nationkey AS csm_name
FROM customer"""

VIEWS["v_assoc"] = """
SELECT CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_acctbal > 0 THEN CAST(c_custkey // 2 AS VARCHAR) END AS grupo_economico_id
FROM customer"""

VIEWS["v_groups"] = """
SELECT CAST(c_custkey // 2 AS VARCHAR) AS id, max(c_acctbal) / 100 AS grupo_economico__potencial_total
FROM customer GROUP BY 1"""

VIEWS["v_order_serials"] = """
SELECT l_orderkey, list(CAST(l_partkey AS VARCHAR) ORDER BY l_partkey) AS parts, min(l_partkey) AS low_part, max(l_partkey) AS high_part, min(l_suppkey) AS owner
FROM lineitem GROUP BY l_orderkey"""

VIEWS["v_cube"] = """
SELECT 'E' || o_orderkey AS ticket_id,
       CASE WHEN NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'O') THEN CAST(o_custkey AS VARCHAR) END AS company_id,
       CAST(o_orderkey AS VARCHAR) AS ticket_associated_deal_id, 'Envios' AS pipeline_label,
       CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN 'Envio Cancelado'
            WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'Envio Retornado'
            ELSE 'Envio Entregue' END AS ticket_status,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Primeira compra' WHEN '2-HIGH' THEN 'Upsell' WHEN '3-MEDIUM' THEN 'Troca'
            WHEN '4-NOT SPECIFIED' THEN 'Upgrade' ELSE 'Downgrade' END AS envio__classe,
       CAST(NULL AS BIGINT) AS instalacao__qtd_dispositivos_efetivamente_agendados,
       CAST(NULL AS VARCHAR[]) AS instalacao__esns_processados
FROM orders
UNION ALL
SELECT 'S' || o_orderkey, CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), 'Serviços',
       CASE o_orderstatus WHEN 'O' THEN 'Agendar instalação' WHEN 'P' THEN 'Aguardando tecnico instalar' ELSE 'Concluído' END,
       NULL, CAST(floor(o_totalprice / 100000) AS BIGINT),
       CASE WHEN parts IS NULL THEN NULL
            WHEN o_orderpriority = '2-HIGH' THEN list_append(parts, 'X' || o_orderkey)
            ELSE parts END
FROM orders LEFT JOIN v_order_serials ON l_orderkey = o_orderkey"""

VIEWS["v_deliveries"] = """
SELECT 'E' || l_orderkey AS ticket_id_crm,
       CASE WHEN l_tax = 0 AND l_discount = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS esn,
       CAST(l_suppkey AS VARCHAR) AS unit_id,
       CASE WHEN l_linenumber = 7
            THEN CASE l_suppkey % 4 WHEN 0 THEN 'PAREM' WHEN 1 THEN 'PAPNP' WHEN 2 THEN 'PAPERCAMAUX' ELSE 'PAPERCARTR' END || l_suppkey
            WHEN l_linenumber = 6 AND l_returnflag = 'N'
            THEN CASE l_suppkey % 7 WHEN 0 THEN 'PAPERCAMAUXCD' WHEN 1 THEN 'PAPERCHAVIDE' WHEN 2 THEN 'PAPERCAMAUXCI'
                 WHEN 3 THEN 'PAPERCAMAUXCE' WHEN 4 THEN 'PAPERCARTRFID125' WHEN 5 THEN 'PAPERCARTRFID013' END
            ELSE 'DEV' || l_linenumber END AS sku,
       'M' || l_linenumber AS modelo_item, l_returnflag || l_linestatus AS item_name, l_shipdate AS created_at
FROM lineitem"""

VIEWS["v_device_deliveries"] = """
SELECT * FROM v_deliveries
WHERE sku NOT LIKE 'PAREM%' AND sku NOT LIKE 'PAPNP%' AND sku NOT LIKE 'PAPERCAMAUX%' AND sku NOT LIKE 'PAPERCARTR%'
  AND sku NOT IN ('PAPERCAMAUXCD', 'PAPERCHAVIDE', 'PAPERCAMAUXCI', 'PAPERCAMAUXCE', 'PAPERCARTRFID125', 'PAPERCARTRFID013')"""

VIEWS["v_devices"] = """
SELECT CAST(l_partkey AS VARCHAR) AS esn, CAST(l_suppkey AS VARCHAR) AS unit_id,
       CASE WHEN l_linenumber <> 5 THEN 'OS' || l_orderkey || '-' || l_linenumber END AS ordem_de_servico
FROM lineitem"""

VIEWS["v_finished"] = """
SELECT 'OS' || l_orderkey || '-' || l_linenumber AS ordem_de_servico, CAST(l_shipdate AS DATE) AS data_servico
FROM lineitem WHERE l_returnflag = 'A'"""

VIEWS["v_scores"] = """
SELECT company_id, 'G' || (CAST(company_id AS BIGINT) // 2) AS id_grupo_economico, 'Empresa ' || company_id AS company_name, event_week,
       (cents // n) / 100 AS basic_value_score,
       CAST(least(4, cents // (n * 1500)) AS BIGINT) AS instalation_completeness_grade, cents / 100 AS mrr
FROM (SELECT CAST(user_id AS VARCHAR) AS company_id, CAST(date_trunc('week', ts) AS DATE) AS event_week,
             CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS n
      FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)"""

VIEWS["v_names"] = "SELECT company_id, max(company_name) AS company_name FROM v_scores GROUP BY company_id"

VIEWS["v_score"] = """
SELECT * FROM v_scores AS s
WHERE event_week = (SELECT max(event_week) FROM v_scores AS o WHERE o.company_id = s.company_id)"""

VIEWS["v_checks"] = """
SELECT 'S' || user_id AS ticket_id, event_type AS status_tratativa, props AS observacao, ts AS updated_at FROM events"""

VIEWS["v_note"] = """
SELECT ticket_id, status_tratativa, observacao, updated_at AS tratativa_updated_at FROM v_checks
QUALIFY row_number() OVER (PARTITION BY ticket_id
  ORDER BY updated_at DESC, status_tratativa DESC, observacao DESC) = 1"""

VIEWS["v_acks"] = "SELECT 'S' || user_id AS ticket_id, ts AS marked_at FROM events WHERE event_type = 'signup'"

VIEWS["v_members"] = """
SELECT s_name || '@example.com' AS email, s_name AS name,
       CASE WHEN s_acctbal > 9000 THEN NULL WHEN s_nationkey < 8 THEN 'onboarding'
            WHEN s_nationkey < 16 THEN 'smb' ELSE 'icp' END AS squad,
       CASE WHEN s_acctbal > 9000 THEN 'gestor_geral' WHEN s_acctbal > 8000 THEN 'gestor_squad'
            ELSE 'colaborador' END AS role,
       s_acctbal > 0 AS active, s_suppkey AS hubspot_owner_id
FROM supplier"""

VIEWS["v_grants"] = """
SELECT s_name || '@example.com' AS owner_email,
       'Supplier#' || lpad(CAST(s_nationkey AS VARCHAR), 9, '0') || '@example.com' AS grantee_email
FROM supplier"""

VIEWS["v_field_events"] = """
SELECT 'S' || l_orderkey || CASE WHEN l_linenumber = 1 THEN '' ELSE '-' || (l_linenumber - 1) END AS ordem_de_servico,
       CASE l_linestatus WHEN 'O' THEN 'AGENDADA' ELSE 'CONCLUÍDA' END AS status,
       'prestador ' || l_suppkey AS prestador,
       CASE WHEN l_returnflag <> 'N' THEN 'consultor ' || l_returnflag END AS consultor,
       CAST(l_shipdate AS DATE) AS data_agendada, 'cliente ' || l_partkey AS cliente
FROM lineitem"""

VIEWS["v_field_all"] = """
SELECT ordem_de_servico AS ordem_servico_raw, split_part(ordem_de_servico, '-', 1) AS ticket_id,
       CAST(nullif(split_part(ordem_de_servico, '-', 2), '') AS BIGINT) AS suffix_num,
       status, prestador, consultor, data_agendada, cliente
FROM v_field_events"""

VIEWS["v_field"] = """
SELECT * FROM v_field_all
QUALIFY row_number() OVER (PARTITION BY ordem_servico_raw
  ORDER BY data_agendada DESC, prestador DESC, cliente DESC, status DESC, consultor DESC NULLS LAST) = 1"""

VIEWS["v_crm"] = """
SELECT 'S' || o_orderkey AS hs_object_id,
       CASE WHEN o_orderpriority = '1-URGENT'
            THEN '[SUPPLY | novo] Instalação Cliente ' || o_custkey || ' Deal ID: ' || o_orderkey
            ELSE 'Ticket ' || o_orderkey END AS subject,
       o_custkey, o_orderkey, o_orderpriority, o_totalprice,
       o_orderdate + to_hours(CAST(3 * (o_orderkey % 8) AS BIGINT)) AS createdate,
       CASE o_orderpriority WHEN '3-MEDIUM' THEN '111111' ELSE '263640' END AS hs_pipeline,
       CASE o_orderstatus WHEN 'O' THEN '263641' ELSE '999999' END AS hs_pipeline_stage,
       parts, CAST(low_part AS VARCHAR) AS low_part, CAST(high_part AS VARCHAR) AS high_part, owner AS ops_owner,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS VARCHAR) END AS company_id,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_orderkey AS VARCHAR) END AS deal_id
FROM orders LEFT JOIN v_order_serials ON l_orderkey = o_orderkey"""

VIEWS["v_tickets"] = """
SELECT c.hs_object_id AS ticket_id, c.subject AS subject_raw,
       CASE WHEN n.company_name IS NOT NULL THEN n.company_name
            WHEN o_orderpriority = '1-URGENT' THEN 'Cliente ' || o_custkey ELSE c.subject END AS display_name,
       c.hs_pipeline_stage AS pipeline_stage_id,
       CASE WHEN hs_pipeline = '263640' AND hs_pipeline_stage = '263641' THEN 'Agendar Instalação' END AS pipeline_stage_label,
       o_orderpriority AS classe_instalacao, ops_owner AS owner_hubspot_id, s_name AS owner_name, c.company_id, c.deal_id,
       c.createdate, CAST(coalesce(len(parts), 0) AS BIGINT) AS esn_count,
       coalesce(array_to_string(parts, ','), '') AS esn_list,
       hs_pipeline = '263640' AND hs_pipeline_stage = '263641' AS in_agendar_instalacao
FROM v_crm AS c
LEFT JOIN v_names AS n ON n.company_id = c.company_id
LEFT JOIN supplier ON s_suppkey = ops_owner
WHERE (hs_pipeline = '263640' AND hs_pipeline_stage = '263641')
   OR EXISTS (SELECT 1 FROM v_field AS f WHERE f.ticket_id = c.hs_object_id AND f.status = 'CONCLUÍDA')"""

VIEWS["v_newest"] = """
SELECT esn, ticket_id_crm AS dono_ticket_id, modelo_item, item_name FROM v_deliveries WHERE esn IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY esn
  ORDER BY created_at DESC, ticket_id_crm DESC, modelo_item DESC, item_name DESC) = 1"""

VIEWS["v_owner_company"] = """
SELECT DISTINCT ticket_id AS dono_ticket_id, company_id AS dono_company_id FROM v_cube WHERE company_id IS NOT NULL"""

VIEWS["v_expected"] = """
SELECT ticket_id, company_id, unnest(instalacao__esns_processados) AS esn FROM v_cube
WHERE pipeline_label = 'Serviços' AND ticket_status = 'Agendar instalação' AND company_id IS NOT NULL"""

VIEWS["v_pairs"] = """
SELECT e.ticket_id, e.company_id AS company_id_esperado, e.esn, n.modelo_item, n.item_name, n.dono_ticket_id, c.dono_company_id,
       CASE WHEN c.dono_company_id = e.company_id THEN 'ok' WHEN c.dono_company_id IS NOT NULL THEN 'divergente'
            ELSE 'sem_match' END AS esn_status
FROM v_expected AS e LEFT JOIN v_newest AS n ON n.esn = e.esn
LEFT JOIN v_owner_company AS c ON c.dono_ticket_id = n.dono_ticket_id"""

VIEWS["v_downgraded"] = """
SELECT ticket_associated_deal_id FROM v_lines WHERE product_id IN ('11', '12') AND fin__config_tipo = 'Downgrade'
GROUP BY ticket_associated_deal_id HAVING sum(quantidade_alterados) > 0"""

VIEWS["v_typed"] = """
SELECT *, fin__config_tipo IN ('Troca', 'Upgrade', 'Downgrade') AS is_swap,
       CASE WHEN fin__config_tipo LIKE 'Primeira venda%' THEN 'Primeira venda' ELSE fin__config_tipo END AS class_label
FROM v_lines
WHERE fin__config_tipo IN ('Primeira venda', 'Primeira venda [Upsell]', 'Upsell', 'Troca', 'Upgrade', 'Downgrade')
  AND product_id IN ('1', '3', '4', '5', '6', '8', '31', '32')
  AND data_inicio_assinatura >= DATE '1995-01-01'"""

VIEWS["v_grain"] = """
SELECT associated_company_id, ticket_associated_deal_id, data_inicio_assinatura,
       CAST(coalesce(sum(quantidade_alterados) FILTER (NOT is_swap), 0) AS BIGINT) AS qtd_contratada_venda,
       CAST(coalesce(sum(mrr_total_produto) FILTER (NOT is_swap), 0) AS DOUBLE) AS mrr_total,
       array_to_string(list_sort(list(DISTINCT class_label)), ', ') AS classe_deal,
       CASE WHEN bool_or(is_swap) THEN 'TROCA' ELSE 'VENDA' END AS grupo_deal
FROM v_typed GROUP BY 1, 2, 3 HAVING bool_or(is_swap) = bool_and(is_swap)"""

VIEWS["v_contracts"] = """
SELECT g.*, c.razao_social, c.endereco_uf, c.status_da_empresa, c.fleet_size_empresa, c.potencial_total_da_empresa, c.csm_name
FROM v_grain AS g JOIN v_companies AS c ON c.id = g.associated_company_id
WHERE c.status_da_empresa IN ('Onboarding', 'Ongoing')
  AND g.ticket_associated_deal_id NOT IN (SELECT ticket_associated_deal_id FROM v_downgraded)"""

VIEWS["v_churn"] = """
SELECT associated_company_id, max(data_inicio_assinatura) AS ultimo_churn
FROM v_lines WHERE fin__config_tipo = 'Abandono total' GROUP BY 1"""

VIEWS["v_sales_since"] = """
SELECT l.* FROM v_lines AS l LEFT JOIN v_churn AS c USING (associated_company_id)
WHERE l.fin__config_tipo IN ('Primeira venda', 'Primeira venda [Upsell]')
  AND (c.ultimo_churn IS NULL OR l.data_inicio_assinatura >= c.ultimo_churn)"""

VIEWS["v_first_sale"] = """
SELECT associated_company_id, min(data_inicio_assinatura) AS data_primeira_venda_atual FROM v_sales_since GROUP BY 1"""

VIEWS["v_group_members"] = """
SELECT a.id AS associated_company_id, a.grupo_economico_id, f.data_primeira_venda_atual
FROM v_assoc AS a JOIN v_companies AS c ON c.id = a.id AND c.status_da_empresa IN ('Onboarding', 'Ongoing')
JOIN v_first_sale AS f ON f.associated_company_id = a.id"""

VIEWS["v_group_facts"] = """
SELECT m.grupo_economico_id, min(m.data_primeira_venda_atual) AS grupo_data_primeira_venda,
       max(g.grupo_economico__potencial_total) AS grupo_potencial
FROM v_group_members AS m LEFT JOIN v_groups AS g ON g.id = m.grupo_economico_id GROUP BY 1"""

VIEWS["v_ships"] = """
SELECT t.ticket_associated_deal_id, d.esn, d.unit_id, t.envio__classe
FROM v_cube AS t JOIN v_device_deliveries AS d ON d.ticket_id_crm = t.ticket_id
WHERE t.pipeline_label = 'Envios' AND t.ticket_status NOT IN ('Envio Retornado', 'Envio Cancelado') AND d.esn IS NOT NULL"""

VIEWS["v_unique_ships"] = """
SELECT ticket_associated_deal_id, esn, envio__classe, unit_id FROM v_ships
QUALIFY row_number() OVER (PARTITION BY ticket_associated_deal_id, esn ORDER BY envio__classe, unit_id) = 1"""

VIEWS["v_serials"] = """
SELECT s.ticket_associated_deal_id, s.esn, s.envio__classe, min(f.data_servico) AS data_servico,
       coalesce(bool_or(d.ordem_de_servico IS NOT NULL), false) AS has_order
FROM v_unique_ships AS s
LEFT JOIN v_devices AS d ON d.esn = s.esn AND d.unit_id = s.unit_id
LEFT JOIN v_finished AS f ON f.ordem_de_servico = d.ordem_de_servico
GROUP BY 1, 2, 3"""

VIEWS["v_installs"] = """
SELECT s.ticket_associated_deal_id, c.data_inicio_assinatura, s.esn, s.envio__classe, s.data_servico,
       CASE WHEN CASE WHEN s.data_servico IS NULL THEN s.has_order ELSE s.data_servico >= c.data_inicio_assinatura END
            THEN 'Instalado' ELSE 'Não Instalado' END AS status_instalacao
FROM v_serials AS s JOIN (SELECT DISTINCT ticket_associated_deal_id, data_inicio_assinatura FROM v_contracts) AS c
  USING (ticket_associated_deal_id)"""

VIEWS["v_install_counts"] = """
SELECT ticket_associated_deal_id, data_inicio_assinatura, count(DISTINCT esn) AS qtd_enviada,
       count(DISTINCT CASE WHEN status_instalacao = 'Instalado' THEN esn END) AS qtd_instalada
FROM v_installs GROUP BY 1, 2"""

VIEWS["v_scheduled"] = """
SELECT ticket_associated_deal_id, CAST(sum(instalacao__qtd_dispositivos_efetivamente_agendados) AS BIGINT) AS qtd_agendado
FROM v_cube WHERE ticket_status = 'Aguardando tecnico instalar' AND instalacao__qtd_dispositivos_efetivamente_agendados > 0
GROUP BY 1"""

VIEWS["v_base"] = """
SELECT c.ticket_associated_deal_id AS deal_id, c.associated_company_id AS company_id, c.razao_social, c.status_da_empresa,
       c.fleet_size_empresa, c.potencial_total_da_empresa, c.data_inicio_assinatura, c.classe_deal, c.grupo_deal,
       c.qtd_contratada_venda, c.mrr_total, p.data_primeira_venda_atual, a.grupo_economico_id, g.grupo_data_primeira_venda,
       g.grupo_potencial, coalesce(i.qtd_enviada, 0) AS qtd_enviada, coalesce(i.qtd_instalada, 0) AS qtd_instalada,
       coalesce(s.qtd_agendado, 0) AS qtd_agendado,
       DATE '2001-08-01' - c.data_inicio_assinatura AS dias_desde_assinatura,
       DATE '2001-08-01' - coalesce(g.grupo_data_primeira_venda, p.data_primeira_venda_atual) AS dias_1a_venda_grupo,
       coalesce(g.grupo_potencial, c.potencial_total_da_empresa) AS potencial,
       CASE WHEN DATE '2001-08-01' - coalesce(g.grupo_data_primeira_venda, p.data_primeira_venda_atual) <= 90 THEN 'Onboarding'
            WHEN coalesce(g.grupo_potencial, c.potencial_total_da_empresa) > 50 THEN 'ICP' ELSE 'SMB' END AS time_segmento
FROM v_contracts AS c
LEFT JOIN v_first_sale AS p USING (associated_company_id)
LEFT JOIN v_assoc AS a ON a.id = c.associated_company_id
LEFT JOIN v_group_facts AS g ON g.grupo_economico_id = a.grupo_economico_id
LEFT JOIN v_install_counts AS i ON i.ticket_associated_deal_id = c.ticket_associated_deal_id
  AND i.data_inicio_assinatura = c.data_inicio_assinatura
LEFT JOIN v_scheduled AS s ON s.ticket_associated_deal_id = c.ticket_associated_deal_id"""

# Ratios are rounded half up on integers, because rounding doubles differs
# between engines at the halfway points.
VIEWS["v_metrics"] = """
SELECT *, greatest(qtd_completude - qtd_instalada, 0) AS qtd_pendente,
       qtd_instalada + qtd_agendado AS qtd_instalada_mais_agendado,
       CASE WHEN qtd_completude = 0 THEN 1.0
            ELSE least((200 * qtd_instalada + qtd_completude) // (2 * qtd_completude), 100) / 100 END AS pct_completude,
       CASE WHEN qtd_completude = 0 THEN 1.0
            ELSE least((200 * (qtd_instalada + qtd_agendado) + qtd_completude) // (2 * qtd_completude), 100) / 100
            END AS pct_completude_com_agendado,
       (time_segmento = 'Onboarding') = (classe_deal LIKE '%Primeira venda%') AS elegivel,
       dias_desde_assinatura <= prazo AS dentro_do_prazo, prazo - dias_desde_assinatura AS dias_restantes_prazo
FROM (SELECT *, CASE grupo_deal WHEN 'TROCA' THEN qtd_enviada ELSE qtd_contratada_venda END AS qtd_completude,
             CASE time_segmento WHEN 'Onboarding' THEN 90 ELSE 60 END AS prazo FROM v_base)"""

VIEWS["v_graded"] = """
SELECT *, CAST(CASE WHEN whole = 0 THEN 0 WHEN whole <= 75 THEN 1 WHEN whole <= floor3 - 1 THEN 2
                    WHEN whole <= top3 THEN 3 ELSE 4 END AS BIGINT) AS nota_instalacao,
       greatest((8 * qtd_completude + 9) // 10 - qtd_instalada, 0) AS qtd_falta_meta_80,
       greatest((floor3 * qtd_completude + 99) // 100 - qtd_instalada, 0) AS qtd_falta_nota_3
FROM (SELECT *, CAST(round(pct_completude * 100) AS BIGINT) AS whole,
             CASE WHEN icp THEN 80 ELSE 90 END AS floor3, CASE WHEN icp THEN 85 ELSE 95 END AS top3
      FROM (SELECT *, time_segmento = 'ICP' OR (time_segmento = 'Onboarding' AND coalesce(potencial, 0) > 50) AS icp
            FROM v_metrics WHERE elegivel AND qtd_completude > 0))"""

VIEWS["v_deals"] = """
SELECT deal_id, company_id, time_segmento, qtd_completude, qtd_instalada, pct_completude, qtd_falta_meta_80,
       dentro_do_prazo, dias_restantes_prazo, nota_instalacao, qtd_falta_nota_3
FROM v_graded
QUALIFY row_number() OVER (PARTITION BY deal_id
  ORDER BY dias_restantes_prazo DESC, company_id, qtd_completude, qtd_instalada, time_segmento) = 1"""

VIEWS["v_ticket_pairs"] = "SELECT DISTINCT * FROM v_pairs"

VIEWS["v_esn_ticket"] = """
SELECT ticket_id, count(*) FILTER (esn_status = 'divergente') AS esn_divergente_count,
       count(*) FILTER (esn_status = 'sem_match') AS esn_sem_match_count,
       string_agg(DISTINCT modelo_item, ',' ORDER BY modelo_item) AS esn_modelos_raw,
       string_agg(esn || ':' || coalesce(modelo_item, '') || ':' || esn_status || ':' || coalesce(dono_ticket_id, '')
                  || ':' || coalesce(dono_company_id, ''), ';' ORDER BY esn) AS esn_detalhe
FROM v_ticket_pairs GROUP BY ticket_id"""

VIEWS["v_dash"] = """
SELECT t.ticket_id, t.display_name, t.subject_raw, t.pipeline_stage_label, t.in_agendar_instalacao, t.classe_instalacao,
       t.owner_name, t.owner_hubspot_id, m.squad AS owner_squad, CAST(t.createdate AS DATE) AS createdate,
       (epoch_us(TIMESTAMP '2001-08-01') - epoch_us(t.createdate)) / 86400000000 AS dias_aberto,
       t.esn_count, t.company_id, t.deal_id, s.id_grupo_economico, s.company_name,
       s.basic_value_score, s.instalation_completeness_grade, s.mrr,
       CASE WHEN d.nota_instalacao < 3 THEN 'em_risco' ELSE 'ok' END AS mrr_status,
       f.status AS field_status, f.prestador, f.consultor, f.data_agendada,
       n.status_tratativa, n.observacao, n.tratativa_updated_at,
       d.time_segmento AS completude_time_segmento, d.qtd_completude AS completude_qtd_completude,
       d.qtd_instalada AS completude_qtd_instalada, d.pct_completude AS completude_pct,
       d.qtd_falta_meta_80 AS completude_qtd_falta, d.dentro_do_prazo AS completude_dentro_do_prazo,
       d.nota_instalacao AS completude_nota_instalacao, d.qtd_falta_nota_3 AS completude_qtd_falta_nota_3,
       d.dias_restantes_prazo AS completude_dias_restantes_prazo,
       e.esn_divergente_count, e.esn_sem_match_count, e.esn_modelos_raw, e.esn_detalhe
FROM v_tickets AS t
LEFT JOIN v_members AS m ON m.hubspot_owner_id = t.owner_hubspot_id
LEFT JOIN v_score AS s ON s.company_id = t.company_id
LEFT JOIN v_field AS f ON f.ticket_id = t.ticket_id AND f.suffix_num IS NULL
LEFT JOIN v_deals AS d ON d.deal_id = t.deal_id
LEFT JOIN v_esn_ticket AS e ON e.ticket_id = t.ticket_id
LEFT JOIN v_note AS n ON n.ticket_id = t.ticket_id"""

VIEWS["v_base_orders"] = """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'O'"""

VIEWS["v_new_orders"] = """
SELECT o_orderkey, 'N' || o_orderstatus AS o_orderstatus,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice * 2 END AS o_totalprice
FROM orders WHERE o_orderstatus <> 'F'"""

VIEWS["v_upserted"] = """
SELECT coalesce(n.o_orderkey, b.o_orderkey) AS o_orderkey,
       CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
       CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
       b.o_orderpriority
FROM v_base_orders AS b FULL JOIN v_new_orders AS n ON n.o_orderkey = b.o_orderkey"""


def compose(body: str, given: frozenset[str] = frozenset()) -> str:
    """The statement with the views it uses, in dependency order.

    Names in ``given`` exist as tables and are not expanded.
    """
    needed: set[str] = set()
    pending = [body]
    while pending:
        for name in re.findall(r"\bv_\w+", pending.pop()):
            if name in VIEWS and name not in needed and name not in given:
                needed.add(name)
                pending.append(VIEWS[name])
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in VIEWS.items() if name in needed)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()
