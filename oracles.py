"""Equivalent SQL for every registered query, for DuckDB on the same tables.

Written independently of the Spark plans: one chain of common table expressions builds the
whole warehouse from the provided tables, and each query reads from it. Ratios use integer
half-up arithmetic because DuckDB divides decimals as doubles.
"""

import re

from armazem import vocabulary as v
from armazem.sources.catalog import RAW_TABLES

# Parameters of the registered queries on the test tables.
STATE = "NATION_3"
YEAR = 1997
DICE_YEARS = (1997, 1998)
DICE_REGIONS = ("ASIA", "EUROPE")
DICE_PAYMENTS = ("Boleto", "Cartão de crédito")
PIVOT_YEARS = (1996, 1997, 1998)
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
MIN_ORDERS = 20
MIN_ITEMS = 150
MIN_RATINGS = 180
MIN_MONTH = 10
RECURRING_ABOVE = 20


def _list(values, around: str = "") -> str:
    return around[:1] + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in values) + around[1:]


def half_up(n: str, d: str, places: int, precision: int) -> str:
    """n / d for integers, rounded half away from zero to a decimal."""
    n, d = f"CAST({n} AS HUGEINT)", f"NULLIF(CAST({d} AS HUGEINT), 0)"
    scale = 10**places
    q = (
        f"CASE WHEN {n} >= 0 THEN (2 * {n} * {scale} + {d}) // (2 * {d})"
        f" ELSE -((2 * (-{n}) * {scale} + {d}) // (2 * {d})) END"
    )
    unit = f"CAST({1 / scale:.{places}f} AS DECIMAL({places + 1},{places}))"
    return f"CAST(CAST({q} AS BIGINT) * {unit} AS DECIMAL({precision},{places}))"


def cents(x: str) -> str:
    return f"(({x}) * 100)"


def money_per(x: str, n: str) -> str:
    return half_up(cents(x), f"({n}) * 100", 2, 18)


def per(x: str, n: str, places: int) -> str:
    return half_up(x, n, places, 18)


def pct(part: str, whole: str) -> str:
    """Both operands integers, or both amounts turned into cents."""
    return half_up(f"({part}) * 100", whole, 2, 9)


def pct_money(part: str, whole: str) -> str:
    return pct(cents(part), cents(whole))


def total(x: str) -> str:
    return f"CAST({x} AS DECIMAL(28,2))"


def words(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, "
        r"'[\p{L}\p{N}]+|[^\p{L}\p{N}]+'), lambda p: CASE WHEN p[1] = 'ß' THEN p ELSE upper(p[1]) || p[2:] END), '')"
    )


def label(x: str) -> str:
    plain = f"translate(lower(trim({x})), '{v.ACCENTED}', '{v.UNACCENTED}')"
    text = words(rf"regexp_replace({plain}, '\s+', ' ', 'g')")
    for p in v.LOWERCASE_PARTICLES:
        text = f"replace({text}, ' {p} ', ' {p.lower()} ')"
    return f"NULLIF({text}, '')"


def bands(x: str, limits, above: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} <= {n} THEN '{t}'" for n, t in limits) + f" ELSE '{above}' END"


def datekey(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def nearest(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(30,6)), 0) AS INTEGER)"


def dense(key: str) -> str:
    return f"row_number() OVER (ORDER BY substr(md5(CAST({key} AS VARCHAR)), 1, 3), {key})"


_PRICE = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(10,2))"
_FREIGHT = f"CAST(ROUND({_PRICE} * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(10,2))"
_STATUS_VALUES = ", ".join(
    f"('{c}', '{t}', {str(e).upper()}, {str(x).upper()}, {n})" for c, t, e, x, n in v.ORDER_STATUS
)

VIEWS = {
    "s_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'unavailable'
                                  WHEN 'P' THEN 'canceled' END AS order_status,
               o_orderdate AS bought,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderdate + INTERVAL 1 DAY END AS approved,
               CASE WHEN shipped >= o_orderdate THEN shipped END AS arrived,
               o_orderdate + INTERVAL 730 DAY AS due
          FROM orders
          LEFT JOIN (SELECT l_orderkey, MAX(l_shipdate) AS shipped FROM lineitem GROUP BY 1) m
                 ON l_orderkey = o_orderkey""",
    "s_items": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS item, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
               {_PRICE} AS price, {_FREIGHT} AS freight
          FROM lineitem""",
    "s_payments": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS sequence,
               CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'credit_card' WHEN 'AO' THEN 'boleto'
                    WHEN 'NF' THEN 'voucher' WHEN 'NO' THEN 'debit_card' WHEN 'RF' THEN 'not_defined'
                    WHEN 'RO' THEN 'gift_card' END AS kind,
               1 + CAST(l_quantity AS INTEGER) % 14 AS instalments,
               CAST({_PRICE} + {_FREIGHT} AS DECIMAL(10,2)) AS value
          FROM lineitem""",
    "s_reviews": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS review_id,
               l_orderkey AS order_id,
               CASE WHEN CAST(l_quantity AS INTEGER) % 7 <> 0 THEN 1 + CAST(l_quantity AS INTEGER) % 5 END AS score,
               l_shipdate AS created,
               CASE WHEN l_linenumber % 3 <> 0 THEN l_shipdate + to_days(l_linenumber) END AS answered
          FROM lineitem""",
    "states": f"""
        SELECT upper(trim(n_name)) AS uf, {label("replace(n_name, '_', ' ')")} AS nome_estado, r_name AS regiao
          FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "s_customers": """
        SELECT c_custkey AS customer_id, c_custkey // 2 AS person,
               CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR) AS zip,
               n_name || ' ' || CAST(c_custkey % 40 AS VARCHAR) AS city, n_name AS state
          FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "s_sellers": """
        SELECT s_suppkey AS seller_id,
               CAST(s_nationkey * 1000 + s_suppkey % 1000 AS VARCHAR) AS zip,
               n_name || ' ' || CAST(s_suppkey % 40 AS VARCHAR) AS city, n_name AS state
          FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "s_positions": """
        SELECT CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR) AS zip,
               CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 0.001 AS DECIMAL(24,5)) AS lat,
               CAST(-35 - CAST(c_acctbal AS DECIMAL(12,2)) * 0.002 AS DECIMAL(24,5)) AS lng,
               c_mktsegment AS city, n_name AS state
          FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL
        SELECT CAST(s_nationkey + 50000 AS VARCHAR),
               CAST(CAST(s_acctbal AS DECIMAL(12,2)) * 0.001 AS DECIMAL(24,5)),
               CAST(-35 - CAST(s_acctbal AS DECIMAL(12,2)) * 0.002 AS DECIMAL(24,5)),
               'depot ' || CAST(s_suppkey % 3 AS VARCHAR), n_name
          FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "s_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 97 <> 0 THEN replace(lower(p_brand), '#', '_') END AS category,
               length(p_name) AS name_length, length(p_name || p_type) AS description_length,
               p_size % 7 AS photos,
               CASE WHEN p_size % 13 <> 0 THEN CAST(p_size AS DECIMAL(9,0)) * 250.5 END AS weight,
               p_size AS len, p_size % 20 + 1 AS hei, CAST(p_size AS DECIMAL(9,0)) * 0.5 + 1 AS wid
          FROM part""",
    "s_translation": """
        SELECT DISTINCT replace(lower(p_brand), '#', '_') AS category,
               replace(lower(p_brand), 'brand#', 'label_') AS english
          FROM part WHERE p_brand NOT LIKE '%5'""",
    "d_tempo": f"""
        SELECT {datekey('data')} AS sk_tempo, data,
               CAST(day(data) AS INTEGER) AS dia, CAST(month(data) AS INTEGER) AS mes,
               ([{_list(v.MONTH_NAMES)}])[month(data)] AS nome_mes,
               ([{_list(v.MONTH_SHORT)}])[month(data)] AS mes_abrev,
               CAST(quarter(data) AS INTEGER) AS trimestre,
               CAST(quarter(data) AS VARCHAR) || 'T' || CAST(year(data) AS VARCHAR) AS nome_trimestre,
               CASE WHEN month(data) <= 6 THEN 1 ELSE 2 END AS semestre,
               CAST(year(data) AS INTEGER) AS ano, strftime(data, '%Y-%m') AS ano_mes,
               CAST(dayofweek(data) AS INTEGER) AS dia_semana,
               ([{_list(v.WEEKDAY_NAMES)}])[dayofweek(data) + 1] AS nome_dia_semana,
               dayofweek(data) IN (0, 6) AS fim_de_semana
          FROM (SELECT CAST(unnest(generate_series(
                    CAST(date_trunc('year', MIN(bought)) AS TIMESTAMP),
                    CAST(date_trunc('year', GREATEST(MAX(due), MAX(arrived))) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS TIMESTAMP),
                    INTERVAL 1 DAY)) AS DATE) AS data FROM s_orders)""",
    "d_status": f"""
        SELECT row_number() OVER (ORDER BY ordem_ciclo, status_original) AS sk_status, *
          FROM (SELECT u.status_original, COALESCE(k.t, {words('u.status_original')}) AS status_descricao,
                       COALESCE(k.e, FALSE) AS flag_entregue, COALESCE(k.x, FALSE) AS flag_cancelado,
                       CAST(COALESCE(k.n, {v.UNLISTED_STATUS_POSITION}) AS INTEGER) AS ordem_ciclo
                  FROM (SELECT DISTINCT lower(trim(order_status)) AS status_original
                          FROM s_orders WHERE order_status IS NOT NULL) u
                  LEFT JOIN (VALUES {_STATUS_VALUES}) k(c, t, e, x, n) ON k.c = u.status_original)""",
    "d_pagamento": f"""
        SELECT CAST(0 AS BIGINT) AS sk_pagamento, '{v.UNKNOWN_PAYMENT_CODE}' AS tipo_pagamento_original,
               '{v.NOT_INFORMED}' AS tipo_pagamento, CAST(0 AS INTEGER) AS num_parcelas,
               '{v.NOT_INFORMED}' AS faixa_parcelas
        UNION ALL
        SELECT row_number() OVER (ORDER BY kind, instalments), kind,
               CASE kind {" ".join(f"WHEN '{c}' THEN '{t}'" for c, t in v.PAYMENT_LABELS)}
                    ELSE {words("replace(kind, '_', ' ')")} END,
               instalments, {bands('instalments', v.INSTALMENT_BANDS, v.INSTALMENTS_ABOVE)}
          FROM (SELECT DISTINCT kind, instalments FROM s_payments WHERE kind IS NOT NULL)""",
    "d_produto": f"""
        SELECT {dense('product_id')} AS sk_produto, product_id,
               COALESCE(p.category, '{v.UNKNOWN_CATEGORY_CODE}') AS categoria_original,
               COALESCE({label("replace(p.category, '_', ' ')")}, '{v.NOT_INFORMED}') AS categoria,
               COALESCE({label("replace(t.english, '_', ' ')")}, {label("replace(p.category, '_', ' ')")},
                        '{v.NOT_INFORMED_EN}') AS categoria_en,
               {nearest('weight')} AS peso_g, {nearest('len')} AS comprimento_cm,
               {nearest('hei')} AS altura_cm, {nearest('wid')} AS largura_cm,
               {nearest('len * hei * wid')} AS volume_cm3,
               CASE WHEN weight IS NULL THEN '{v.NOT_INFORMED}'
                    ELSE {bands('weight', v.WEIGHT_BANDS, v.WEIGHT_ABOVE)} END AS faixa_peso,
               CAST(photos AS INTEGER) AS qtd_fotos, CAST(name_length AS INTEGER) AS tamanho_nome,
               CAST(description_length AS INTEGER) AS tamanho_descricao
          FROM s_products p LEFT JOIN s_translation t ON t.category = p.category""",
    "d_vendedor": f"""
        SELECT {dense('seller_id')} AS sk_vendedor, seller_id, lpad(trim(zip), 5, '0') AS cep_prefixo,
               {label('city')} AS cidade, upper(trim(state)) AS estado, nome_estado, regiao
          FROM s_sellers LEFT JOIN states ON uf = upper(trim(state))""",
    "d_cliente": f"""
        SELECT {dense('person')} AS sk_cliente, person AS customer_unique_id,
               lpad(trim(zip), 5, '0') AS cep_prefixo, {label('city')} AS cidade,
               upper(trim(state)) AS estado, nome_estado, regiao,
               CAST(n AS BIGINT) AS qtd_pedidos, n > {RECURRING_ABOVE} AS flag_recorrente
          FROM (SELECT person, zip, city, state,
                       COUNT(bought) OVER (PARTITION BY person) AS n,
                       row_number() OVER (PARTITION BY person
                           ORDER BY bought DESC NULLS LAST, c.customer_id DESC) AS pos
                  FROM s_customers c LEFT JOIN s_orders o ON o.customer_id = c.customer_id)
          LEFT JOIN states ON uf = upper(trim(state))
         WHERE pos = 1""",
    "places": f"""
        SELECT lpad(trim(zip), 5, '0') AS cep, {label('city')} AS cidade, upper(trim(state)) AS estado, lat, lng
          FROM s_positions WHERE lat BETWEEN -33.75 AND 5.27 AND lng BETWEEN -73.99 AND -34.79""",
    "addresses": f"""
        SELECT lpad(trim(zip), 5, '0') AS cep, {label('city')} AS cidade, upper(trim(state)) AS estado
          FROM (SELECT zip, city, state FROM s_customers UNION ALL SELECT zip, city, state FROM s_sellers)""",
}


def _mode(view: str, column: str) -> str:
    """First by frequency, then by value; NULLs do not count."""
    return f"""(SELECT cep, {column} FROM (
        SELECT cep, {column}, row_number() OVER (PARTITION BY cep ORDER BY COUNT(*) DESC, {column}) AS pos
          FROM {view} WHERE {column} IS NOT NULL GROUP BY cep, {column}) WHERE pos = 1)"""


VIEWS["d_geografia"] = f"""
        SELECT {dense('cep_prefixo')} AS sk_geografia, g.*
          FROM (SELECT COALESCE(t.cep, p.cep) AS cep_prefixo,
                       COALESCE(t.cidade, p.cidade) AS cidade, COALESCE(t.estado, p.estado) AS estado,
                       nome_estado, regiao, latitude_media, longitude_media,
                       CAST(COALESCE(n, 0) AS BIGINT) AS qtd_registros_origem,
                       CASE WHEN p.cep IS NOT NULL THEN '{v.ORIGIN_GEOLOCATION}'
                            ELSE '{v.ORIGIN_TRANSACTIONS}' END AS origem
                  FROM (SELECT a.cep, c.cidade, e.estado, n, latitude_media, longitude_media
                          FROM (SELECT cep, COUNT(*) AS n,
                                       {half_up('SUM(lat) * 100000', 'COUNT(*) * 100000', 6, 9)} AS latitude_media,
                                       {half_up('SUM(lng) * 100000', 'COUNT(*) * 100000', 6, 9)} AS longitude_media
                                  FROM places GROUP BY cep) a
                          LEFT JOIN {_mode('places', 'cidade')} c ON c.cep = a.cep
                          LEFT JOIN {_mode('places', 'estado')} e ON e.cep = a.cep) p
                  FULL JOIN (SELECT a.cep, c.cidade, e.estado
                               FROM (SELECT DISTINCT cep FROM addresses) a
                               LEFT JOIN {_mode('addresses', 'cidade')} c ON c.cep = a.cep
                               LEFT JOIN {_mode('addresses', 'estado')} e ON e.cep = a.cep) t ON t.cep = p.cep
                  LEFT JOIN states ON uf = COALESCE(t.estado, p.estado)) g"""

VIEWS["o_payments"] = """
        SELECT order_id, SUM(value) AS valor_pago, COUNT(*) AS qtd_pagamentos
          FROM s_payments GROUP BY order_id"""
VIEWS["o_main_payment"] = """
        SELECT order_id, kind AS tipo_pagamento_original, instalments AS num_parcelas
          FROM (SELECT *, row_number() OVER (PARTITION BY order_id
                    ORDER BY value DESC NULLS FIRST, sequence, kind DESC, instalments DESC) AS pos
                  FROM s_payments) WHERE pos = 1"""
VIEWS["o_items"] = """
        SELECT order_id, COUNT(*) AS qtd_itens, COUNT(DISTINCT product_id) AS qtd_produtos_distintos,
               COUNT(DISTINCT seller_id) AS qtd_vendedores, SUM(price) AS valor_itens, SUM(freight) AS valor_frete
          FROM s_items GROUP BY order_id"""
VIEWS["o_review"] = """
        SELECT order_id, CAST(score AS INTEGER) AS nota_avaliacao
          FROM (SELECT *, row_number() OVER (PARTITION BY order_id
                    ORDER BY answered DESC NULLS LAST, created DESC NULLS LAST, review_id DESC, score DESC) AS pos
                  FROM s_reviews WHERE score IS NOT NULL) WHERE pos = 1"""
VIEWS["f_pedido"] = f"""
        SELECT o.order_id, {datekey('bought')} AS sk_tempo_compra, {datekey('approved')} AS sk_tempo_aprovacao,
               {datekey('arrived')} AS sk_tempo_entrega, {datekey('due')} AS sk_tempo_estimada,
               sk_cliente, sk_geografia, COALESCE(sk_pagamento, 0) AS sk_pagamento, sk_status,
               CAST(COALESCE(qtd_itens, 0) AS INTEGER) AS qtd_itens,
               CAST(COALESCE(qtd_produtos_distintos, 0) AS INTEGER) AS qtd_produtos_distintos,
               CAST(COALESCE(qtd_vendedores, 0) AS INTEGER) AS qtd_vendedores,
               CAST(COALESCE(valor_itens, 0) AS DECIMAL(18,2)) AS valor_itens,
               CAST(COALESCE(valor_frete, 0) AS DECIMAL(18,2)) AS valor_frete,
               CAST(COALESCE(valor_itens + valor_frete, 0) AS DECIMAL(18,2)) AS valor_total,
               CAST(valor_pago AS DECIMAL(18,2)) AS valor_pago,
               CAST(COALESCE(qtd_pagamentos, 0) AS INTEGER) AS qtd_pagamentos,
               CASE WHEN valor_itens + valor_frete > 0
                    THEN {half_up(cents('valor_frete'), cents('valor_itens + valor_frete'), 4, 6)} END AS participacao_frete,
               CAST(datediff('day', bought, arrived) AS INTEGER) AS prazo_entrega_dias,
               CAST(datediff('day', bought, due) AS INTEGER) AS prazo_estimado_dias,
               CAST(datediff('day', due, arrived) AS INTEGER) AS atraso_entrega_dias,
               CAST(arrived AS DATE) > CAST(due AS DATE) AS flag_entregue_com_atraso,
               nota_avaliacao
          FROM s_orders o
          JOIN s_customers c ON c.customer_id = o.customer_id
          JOIN d_cliente dc ON dc.customer_unique_id = c.person
          JOIN d_geografia dg ON dg.cep_prefixo = lpad(trim(c.zip), 5, '0')
          JOIN d_status ds ON ds.status_original = lower(trim(o.order_status))
          LEFT JOIN o_items i ON i.order_id = o.order_id
          LEFT JOIN o_payments y ON y.order_id = o.order_id
          LEFT JOIN o_main_payment m ON m.order_id = o.order_id
          LEFT JOIN d_pagamento dp ON dp.tipo_pagamento_original = m.tipo_pagamento_original
                                  AND dp.num_parcelas = m.num_parcelas
          LEFT JOIN o_review r ON r.order_id = o.order_id"""
VIEWS["f_vendas"] = """
        SELECT sk_tempo_compra AS sk_tempo, sk_cliente, sk_produto, sk_vendedor, sk_geografia, sk_pagamento,
               sk_status, i.order_id, i.item AS order_item_id, i.price AS valor_item, i.freight AS valor_frete,
               CAST(i.price + i.freight AS DECIMAL(10,2)) AS valor_total_item,
               prazo_entrega_dias, atraso_entrega_dias, nota_avaliacao
          FROM s_items i JOIN f_pedido f ON f.order_id = i.order_id
          JOIN d_produto p ON p.product_id = i.product_id
          JOIN d_vendedor w ON w.seller_id = i.seller_id"""
VIEWS["sold"] = """
        SELECT f.*, t.ano, t.trimestre, t.mes, t.nome_mes, t.ano_mes, g.cidade, g.estado, g.regiao, y.tipo_pagamento
          FROM f_vendas f JOIN d_tempo t ON t.sk_tempo = f.sk_tempo
          JOIN d_geografia g ON g.sk_geografia = f.sk_geografia
          JOIN d_pagamento y ON y.sk_pagamento = f.sk_pagamento
          JOIN d_status s ON s.sk_status = f.sk_status
         WHERE NOT s.flag_cancelado"""


def with_views(query: str) -> str:
    """Put the views a query needs, directly or through others, in front of it."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(VIEWS[name])

    visit(query)
    # views only refer to earlier ones, except that the order below is the build order
    chain = [f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in needed]
    return ("WITH " + ",\n".join(chain) + "\n" + query) if chain else query


_SUM = "SUM(valor_item)"
_ORDERS = "COUNT(DISTINCT order_id)"
_SALES = f"{total(_SUM)} AS faturamento, {_ORDERS} AS pedidos, {money_per(_SUM, _ORDERS)} AS ticket_medio"

REPORTS = {
    "o01_rollup_calendar": f"""
        SELECT CASE WHEN GROUPING(ano) = 1 THEN '{v.GRAND_TOTAL}'
                    WHEN GROUPING(trimestre) = 1 THEN 'Total ' || CAST(ano AS VARCHAR)
                    WHEN GROUPING(mes) = 1 THEN 'Total ' || CAST(trimestre AS VARCHAR) || 'T' || CAST(ano AS VARCHAR)
                    ELSE CAST(ano AS VARCHAR) END AS ano,
               CASE WHEN GROUPING(trimestre) = 0 THEN CAST(trimestre AS VARCHAR) || 'T' END AS trimestre,
               nome_mes AS mes,
               {_list(v.LEVELS, "[]")}[4 - GROUPING(ano) - GROUPING(trimestre) - GROUPING(mes)] AS nivel,
               CASE WHEN GROUPING(mes) = 0 THEN MIN(ano_mes) END AS ano_mes, {_SALES}
          FROM sold GROUP BY GROUPING SETS ((ano, trimestre, mes, nome_mes), (ano, trimestre), (ano), ())""",
    "o02_region_state": f"""
        SELECT CASE WHEN GROUPING(regiao) = 1 THEN '{v.GRAND_TOTAL}' ELSE regiao END AS regiao,
               CASE WHEN GROUPING(estado) = 1 THEN '{v.SUBTOTAL}' ELSE estado END AS estado, {_SALES},
               {pct_money(_SUM, '(SELECT SUM(valor_item) FROM sold)')} AS participacao_pct
          FROM sold GROUP BY ROLLUP (regiao, estado)""",
    "o03_top_cities": f"""
        SELECT cidade, {_SALES},
               {pct_money(_SUM, f"(SELECT SUM(valor_item) FROM sold WHERE estado = '{STATE}')")} AS participacao_no_estado_pct
          FROM sold WHERE estado = '{STATE}' GROUP BY cidade ORDER BY {_SUM} DESC, cidade LIMIT 10""",
    "o04_top_categories": f"""
        SELECT categoria, categoria_en, {total(_SUM)} AS faturamento, COUNT(*) AS itens_vendidos,
               {_ORDERS} AS pedidos, {money_per(_SUM, _ORDERS)} AS ticket_medio,
               {pct_money(_SUM, f"(SELECT SUM(valor_item) FROM sold WHERE ano = {YEAR})")} AS participacao_pct
          FROM sold JOIN d_produto USING (sk_produto) WHERE ano = {YEAR}
         GROUP BY categoria, categoria_en ORDER BY {_SUM} DESC, categoria, categoria_en LIMIT 10""",
    "o05_dice_ticket": f"""
        SELECT ano, regiao, tipo_pagamento, {_SALES} FROM sold
         WHERE ano IN ({_list(DICE_YEARS)}) AND regiao IN ({_list(DICE_REGIONS)})
           AND tipo_pagamento IN ({_list(DICE_PAYMENTS)})
         GROUP BY ano, regiao, tipo_pagamento""",
    "o06_payment_by_year": f"""
        SELECT tipo_pagamento,
               {", ".join(f"{total(f'COALESCE(SUM(valor_item) FILTER (WHERE ano = {y}), 0)')} AS fat_{y}" for y in PIVOT_YEARS)},
               {total(_SUM)} AS fat_total,
               {pct_money(_SUM, '(SELECT SUM(valor_item) FROM sold)')} AS participacao_pct
          FROM sold GROUP BY tipo_pagamento""",
    "o07_top_sellers": f"""
        SELECT posicao, seller_id, cidade, estado, {total('f')} AS faturamento, pedidos, itens,
               {money_per('f', 'pedidos')} AS ticket_medio, {pct_money('f', 'everything')} AS participacao_pct,
               {pct_money('running', 'everything')} AS participacao_acumulada_pct
          FROM (SELECT CAST(RANK() OVER (ORDER BY f DESC) AS INTEGER) AS posicao, *, SUM(f) OVER () AS everything,
                       SUM(f) OVER (ORDER BY f DESC) AS running
                  FROM (SELECT sk_vendedor, SUM(valor_item) AS f, {_ORDERS} AS pedidos, COUNT(*) AS itens
                          FROM sold GROUP BY sk_vendedor)) q
          JOIN d_vendedor USING (sk_vendedor) ORDER BY f DESC, seller_id LIMIT 10""",
    "o08_delivery_by_state": f"""
        SELECT CASE WHEN GROUPING(regiao) = 1 THEN '{v.GRAND_TOTAL}' ELSE regiao END AS regiao,
               CASE WHEN GROUPING(estado) = 1 THEN '{v.SUBTOTAL}' ELSE estado END AS estado,
               COUNT(*) AS pedidos_entregues, {per('SUM(prazo_entrega_dias)', 'COUNT(*)', 1)} AS prazo_medio_dias,
               {per('SUM(prazo_estimado_dias)', 'COUNT(*)', 1)} AS prazo_estimado_medio_dias,
               {per('SUM(atraso_entrega_dias)', 'COUNT(*)', 1)} AS desvio_medio_vs_estimado_dias,
               {pct('COUNT(*) FILTER (WHERE flag_entregue_com_atraso)', 'COUNT(*)')} AS taxa_atraso_pct
          FROM f_pedido JOIN d_geografia USING (sk_geografia)
         WHERE prazo_entrega_dias IS NOT NULL GROUP BY ROLLUP (regiao, estado)""",
    "o09_late_sellers": f"""
        SELECT seller_id, cidade, estado, COUNT(*) AS pedidos_entregues,
               {per('SUM(prazo_entrega_dias)', 'COUNT(*)', 1)} AS prazo_medio_dias,
               {pct('COUNT(*) FILTER (WHERE atraso_entrega_dias > 0)', 'COUNT(*)')} AS taxa_atraso_pct
          FROM (SELECT DISTINCT order_id, sk_vendedor, prazo_entrega_dias, atraso_entrega_dias
                  FROM f_vendas WHERE prazo_entrega_dias IS NOT NULL) q
          JOIN d_vendedor USING (sk_vendedor)
         GROUP BY seller_id, cidade, estado HAVING COUNT(*) >= {MIN_ORDERS}
         ORDER BY taxa_atraso_pct DESC, pedidos_entregues DESC, seller_id LIMIT 10""",
    "o10_freight_share": f"""
        SELECT categoria, COUNT(*) AS itens, {total(_SUM)} AS valor_itens,
               {total('SUM(valor_frete)')} AS valor_frete,
               {pct_money('SUM(valor_frete)', 'SUM(valor_total_item)')} AS participacao_frete_pct,
               {money_per('SUM(valor_frete)', 'COUNT(*)')} AS frete_medio_por_item
          FROM sold JOIN d_produto USING (sk_produto) GROUP BY categoria HAVING COUNT(*) >= {MIN_ITEMS}
         ORDER BY participacao_frete_pct DESC, categoria LIMIT 10""",
    "o11_rating_by_delivery": f"""
        SELECT CASE WHEN prazo_entrega_dias IS NULL THEN '{v.DELIVERY_MISSING}'
                    WHEN atraso_entrega_dias < 0 THEN '{v.DELIVERY_EARLY}'
                    WHEN atraso_entrega_dias = 0 THEN '{v.DELIVERY_ON_TIME}'
                    ELSE {bands('atraso_entrega_dias', v.DELIVERY_LATE_BANDS, v.DELIVERY_LATE_ABOVE)} END AS situacao_entrega,
               COUNT(*) AS pedidos, COUNT(nota_avaliacao) AS pedidos_avaliados,
               {per('SUM(nota_avaliacao)', 'COUNT(nota_avaliacao)', 2)} AS nota_media,
               {pct('COUNT(*) FILTER (WHERE nota_avaliacao <= 2)', 'COUNT(nota_avaliacao)')} AS pct_notas_1_e_2,
               {pct('COUNT(*) FILTER (WHERE nota_avaliacao = 5)', 'COUNT(nota_avaliacao)')} AS pct_nota_5
          FROM f_pedido GROUP BY 1""",
    "o12_category_ratings": f"""
        SELECT CASE WHEN best <= 5 THEN '{v.BEST}' ELSE '{v.WORST}' END AS grupo, categoria, avaliacoes,
               nota_media, pct_notas_1_e_2
          FROM (SELECT *, RANK() OVER (ORDER BY nota_media DESC, avaliacoes DESC) AS best,
                       RANK() OVER (ORDER BY nota_media, avaliacoes DESC) AS worst
                  FROM (SELECT categoria, COUNT(*) AS avaliacoes,
                               {per('SUM(nota_avaliacao)', 'COUNT(*)', 2)} AS nota_media,
                               {pct('COUNT(*) FILTER (WHERE nota_avaliacao <= 2)', 'COUNT(*)')} AS pct_notas_1_e_2
                          FROM f_vendas JOIN d_produto USING (sk_produto) WHERE nota_avaliacao IS NOT NULL
                         GROUP BY categoria HAVING COUNT(*) >= {MIN_RATINGS}) c) r
         WHERE best <= 5 OR worst <= 5""",
    "o13_recurring_customers": f"""
        SELECT CASE WHEN GROUPING(regiao) = 1 THEN '{v.GRAND_TOTAL}' ELSE regiao END AS regiao,
               COUNT(*) AS clientes, COUNT(*) FILTER (WHERE flag_recorrente) AS clientes_recorrentes,
               {pct('COUNT(*) FILTER (WHERE flag_recorrente)', 'COUNT(*)')} AS pct_recorrentes,
               {per('SUM(qtd_pedidos)', 'COUNT(*)', 3)} AS pedidos_por_cliente
          FROM d_cliente GROUP BY ROLLUP (regiao)""",
    "o14_cancellation_by_month": f"""
        SELECT ano_mes, COUNT(*) AS pedidos, COUNT(*) FILTER (WHERE flag_cancelado) AS pedidos_cancelados,
               {pct('COUNT(*) FILTER (WHERE flag_cancelado)', 'COUNT(*)')} AS taxa_cancelamento_pct,
               COUNT(*) FILTER (WHERE status_original = 'unavailable') AS pedidos_indisponiveis
          FROM f_pedido JOIN d_tempo ON sk_tempo = sk_tempo_compra JOIN d_status USING (sk_status)
         GROUP BY ano_mes""",
    "o15_region_payment_cube": f"""
        SELECT CASE WHEN GROUPING(regiao) = 1 THEN '{v.ALL_REGIONS}' ELSE regiao END AS regiao,
               CASE WHEN GROUPING(tipo_pagamento) = 1 THEN '{v.ALL_PAYMENTS}' ELSE tipo_pagamento END AS tipo_pagamento,
               {total(_SUM)} AS faturamento, {_ORDERS} AS pedidos
          FROM sold GROUP BY CUBE (regiao, tipo_pagamento)""",
    "o16_lead_matrix": "SELECT CASE WHEN GROUPING(regiao_vendedor) = 1 THEN '" + v.ALL_REGIONS
    + "' ELSE regiao_vendedor END AS regiao_vendedor, COUNT(*) AS pedidos_entregues, "
    + ", ".join(
        per(
            f"SUM(prazo_entrega_dias) FILTER (WHERE regiao_cliente = '{r}')",
            f"COUNT(*) FILTER (WHERE regiao_cliente = '{r}')", 1,
        ) + f" AS para_{r.lower().replace(' ', '_')}"
        for r in REGIONS
    )
    + f", {per('SUM(prazo_entrega_dias)', 'COUNT(*)', 1)} AS prazo_medio_geral"
    + """ FROM (SELECT DISTINCT order_id, w.regiao AS regiao_vendedor, g.regiao AS regiao_cliente, prazo_entrega_dias
                  FROM f_vendas JOIN d_vendedor w USING (sk_vendedor) JOIN d_geografia g USING (sk_geografia)
                 WHERE prazo_entrega_dias IS NOT NULL) q GROUP BY ROLLUP (regiao_vendedor)""",
    "o17_sellers_by_state": f"""
        SELECT estado, regiao, vendedores, {pct('vendedores', 'SUM(vendedores) OVER ()')} AS pct_vendedores,
               {total('f')} AS faturamento, {pct_money('f', 'SUM(f) OVER ()')} AS pct_faturamento,
               CAST(pedidos AS BIGINT) AS pedidos
          FROM (SELECT estado, regiao, COUNT(*) AS vendedores, COALESCE(SUM(x.f), 0) AS f,
                       COALESCE(SUM(x.pedidos), 0) AS pedidos
                  FROM d_vendedor LEFT JOIN (SELECT sk_vendedor, SUM(valor_item) AS f, {_ORDERS} AS pedidos
                                               FROM sold GROUP BY sk_vendedor) x USING (sk_vendedor)
                 GROUP BY estado, regiao) q""",
}


# --- feeds: a query over the report they shape ------------------------------------------------

def _feed(report: str, body: str) -> str:
    """The shape of a report; the views of the report move to the front."""
    return body.replace("REPORT", f"({REPORTS[report]}) r")


_O01, _O02, _O04, _O06 = (
    "o01_rollup_calendar", "o02_region_state", "o04_top_categories", "o06_payment_by_year")
FEEDS = {
    "g01_monthly_revenue": _feed(_O01, f"""
        SELECT ano_mes, faturamento, pedidos,
               row_number() OVER (ORDER BY faturamento DESC, ano_mes) = 1 AS pico
          FROM REPORT WHERE nivel = '{v.LEVELS[-1]}' AND pedidos >= {MIN_MONTH}"""),
    "g02_state_revenue": _feed(_O02, f"SELECT estado, faturamento FROM REPORT WHERE estado <> '{v.SUBTOTAL}'"),
    "g04_category_revenue": _feed(_O04, "SELECT categoria, faturamento FROM REPORT"),
    "g06_stacked_payments": _feed(_O06, f"""
        SELECT ano, tipo_pagamento, valor,
               CAST(COALESCE(SUM(valor) OVER (PARTITION BY ano ORDER BY fat_total DESC, tipo_pagamento
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DECIMAL(28,2)) AS base,
               CAST(SUM(valor) OVER (PARTITION BY ano) AS DECIMAL(28,2)) AS total_ano
          FROM (SELECT tipo_pagamento, fat_total,
                       unnest([{_list(PIVOT_YEARS)}]) AS ano,
                       unnest([{", ".join(f"fat_{y}" for y in PIVOT_YEARS)}]) AS valor
                  FROM REPORT WHERE tipo_pagamento <> '{v.NOT_INFORMED}') q"""),
    "g07_seller_labels": _feed("o07_top_sellers", """
        SELECT posicao, substr(CAST(seller_id AS VARCHAR), 1, 8) || '  (' || cidade || '/' || estado || ')' AS rotulo,
               faturamento FROM REPORT"""),
    "g08_regional_delivery": _feed("o08_delivery_by_state", f"""
        SELECT regiao, prazo_medio_dias, taxa_atraso_pct FROM REPORT
         WHERE estado = '{v.SUBTOTAL}' AND regiao <> '{v.GRAND_TOTAL}'"""),
    "g11_delivery_ratings": _feed("o11_rating_by_delivery", """
        SELECT substr(situacao_entrega, 4) AS rotulo, pedidos, nota_media FROM REPORT"""),
    "g12_rated_categories": _feed("o12_category_ratings", """
        SELECT grupo, categoria, nota_media,
               CAST(row_number() OVER (ORDER BY nota_media DESC, avaliacoes DESC, categoria) AS INTEGER) AS linha,
               CAST(row_number() OVER (PARTITION BY grupo ORDER BY nota_media DESC, avaliacoes DESC, categoria)
                    AS INTEGER) AS linha_no_grupo FROM REPORT"""),
    "g13_recurring_by_region": _feed("o13_recurring_customers", f"""
        SELECT regiao, pct_recorrentes, referencia_pct
          FROM (SELECT *, MAX(CASE WHEN regiao = '{v.GRAND_TOTAL}' THEN pct_recorrentes END) OVER () AS referencia_pct
                  FROM REPORT) q WHERE regiao <> '{v.GRAND_TOTAL}'"""),
    "g14_monthly_cancellation": _feed("o14_cancellation_by_month", f"""
        SELECT ano_mes, taxa_cancelamento_pct,
               row_number() OVER (ORDER BY taxa_cancelamento_pct DESC, ano_mes) = 1 AS pico
          FROM REPORT WHERE pedidos >= {MIN_MONTH}"""),
    "g16_lead_cells": _feed("o16_lead_matrix", f"""
        SELECT regiao_vendedor, destino, prazo_dias, COALESCE(CAST(prazo_dias AS VARCHAR), 'n/d') AS rotulo,
               prazo_dias = MAX(prazo_dias) OVER () AS maior
          FROM (SELECT regiao_vendedor,
                       unnest([{_list(REGIONS)}]) AS destino,
                       unnest([{", ".join(f"para_{r.lower().replace(' ', '_')}" for r in REGIONS)}]) AS prazo_dias
                  FROM REPORT WHERE regiao_vendedor <> '{v.ALL_REGIONS}') q"""),
    "g17_leading_states": _feed("o17_sellers_by_state", """
        SELECT estado || ' (' || regiao || ')' AS rotulo, vendedores
          FROM REPORT ORDER BY vendedores DESC, faturamento DESC, estado LIMIT 10"""),
}


def _kpi(name: str, value: str) -> str:
    return f"SELECT '{name}' AS kpi, CAST(({value}) AS DECIMAL(28,2)) AS valor"


KPIS = " UNION ALL ".join([
    _kpi("faturamento", "SELECT SUM(valor_item) FROM sold"),
    _kpi("pedidos", "SELECT COUNT(DISTINCT order_id) FROM sold"),
    _kpi("ticket_medio", f"SELECT {money_per(_SUM, _ORDERS)} FROM sold"),
    _kpi("participacao_frete_pct",
         f"SELECT {pct_money('SUM(valor_frete)', 'SUM(valor_item + valor_frete)')} FROM sold"),
    _kpi("prazo_medio_dias",
         f"SELECT {per('SUM(prazo_entrega_dias)', 'COUNT(prazo_entrega_dias)', 1)} FROM f_pedido"),
    _kpi("taxa_atraso_pct",
         f"SELECT {pct('COUNT(*) FILTER (WHERE flag_entregue_com_atraso)', 'COUNT(prazo_entrega_dias)')} FROM f_pedido"),
    _kpi("nota_media",
         f"SELECT {per('SUM(nota_avaliacao)', 'COUNT(nota_avaliacao)', 2)} FROM f_pedido"),
    _kpi("taxa_cancelamento_pct",
         f"SELECT {pct('COUNT(*) FILTER (WHERE flag_cancelado)', 'COUNT(*)')} FROM f_pedido JOIN d_status USING (sk_status)"),
    _kpi("clientes_recorrentes_pct",
         f"SELECT {pct('COUNT(*) FILTER (WHERE flag_recorrente)', 'COUNT(*)')} FROM d_cliente"),
])

# --- dimensions and facts -----------------------------------------------------------------------

LOADS = {
    "d01_calendar": "SELECT * FROM d_tempo",
    "d02_status": "SELECT * FROM d_status",
    "d03_payment": "SELECT * FROM d_pagamento",
    "d04_product": "SELECT * FROM d_produto",
    "d05_seller": "SELECT * FROM d_vendedor",
    "d06_customer": "SELECT * FROM d_cliente",
    "d07_geography": "SELECT * FROM d_geografia",
    "d08_dense_keys": f"SELECT {dense('o_orderkey')} AS sk, o_orderkey, o_orderpriority FROM orders",
    "d09_region_lookup": """
        SELECT uf, nome_estado, regiao, clientes
          FROM states LEFT JOIN (SELECT upper(trim(state)) AS uf, COUNT(*) AS clientes FROM s_customers GROUP BY 1) c
               USING (uf)""",
    "f01_order_fact": "SELECT * FROM f_pedido",
    "f02_item_fact": "SELECT * FROM f_vendas",
    "f03_main_payment": "SELECT * FROM o_main_payment",
    "f04_latest_review": "SELECT * FROM o_review",
    "f05_item_rollup": f"""
        SELECT order_id, qtd_itens, qtd_produtos_distintos, qtd_vendedores,
               {total('valor_itens')} AS valor_itens, {total('valor_frete')} AS valor_frete FROM o_items""",
    "f06_payment_rollup": f"""
        SELECT order_id, {total('valor_pago')} AS valor_pago, qtd_pagamentos FROM o_payments""",
    "f07_delivery_measures": """
        SELECT order_id, CAST(datediff('day', bought, arrived) AS INTEGER) AS prazo_entrega_dias,
               CAST(datediff('day', bought, due) AS INTEGER) AS prazo_estimado_dias,
               CAST(datediff('day', due, arrived) AS INTEGER) AS atraso_entrega_dias,
               CAST(arrived AS DATE) > CAST(due AS DATE) AS flag_entregue_com_atraso
          FROM s_orders""",
}

# --- validations ------------------------------------------------------------------------------------

_RAW_VIEWS = {
    "orders": "s_orders", "order_items": "s_items", "order_payments": "s_payments",
    "order_reviews": "s_reviews", "customers": "s_customers", "products": "s_products",
    "sellers": "s_sellers", "geolocation": "s_positions", "category_translation": "s_translation",
}
_DIMS = {
    "dim_tempo": ("d_tempo", "sk_tempo"), "dim_cliente": ("d_cliente", "sk_cliente"),
    "dim_produto": ("d_produto", "sk_produto"), "dim_vendedor": ("d_vendedor", "sk_vendedor"),
    "dim_geografia": ("d_geografia", "sk_geografia"), "dim_pagamento": ("d_pagamento", "sk_pagamento"),
    "dim_status": ("d_status", "sk_status"),
}
_WAREHOUSE = {name: view for name, (view, _) in _DIMS.items()} | {
    "fato_pedido": "f_pedido", "fato_vendas": "f_vendas"}


def _one(sql: str) -> str:
    return f"CAST((SELECT {sql}) AS VARCHAR)"


def _sum(x: str) -> str:
    return f"CAST(SUM({x}) AS DECIMAL(28,2))"


def _lost(fact: str, key: str, dim: str, dim_key: str) -> str:
    return f"COUNT(*) FROM {fact} f LEFT JOIN {dim} d ON d.{dim_key} = f.{key} WHERE d.{dim_key} IS NULL"


def _checks() -> str:
    zero = "'0'"
    sides = {
        1: (_one("COUNT(*) FROM s_items"), _one("COUNT(*) FROM f_vendas")),
        2: (_one("COUNT(*) FROM s_orders"), _one("COUNT(*) FROM f_pedido")),
        3: (_one(f"{_sum('price')} FROM s_items"), _one(f"{_sum('valor_item')} FROM f_vendas")),
        4: (_one(f"{_sum('freight')} FROM s_items"), _one(f"{_sum('valor_frete')} FROM f_vendas")),
        5: (_one(f"{_sum('value')} FROM s_payments"), _one(f"{_sum('valor_pago')} FROM f_pedido")),
        6: (_one("COUNT(DISTINCT order_id) FROM s_items"), _one("COUNT(DISTINCT order_id) FROM f_vendas")),
        7: (zero, _one("COUNT(*) FROM f_pedido p JOIN (SELECT order_id, SUM(valor_item) AS x FROM f_vendas"
                       " GROUP BY 1) q USING (order_id) WHERE x <> valor_itens")),
        15: (zero, _one("COUNT(*) FROM f_pedido f LEFT JOIN d_tempo a ON a.sk_tempo = sk_tempo_compra"
                        " LEFT JOIN d_tempo b ON b.sk_tempo = sk_tempo_estimada"
                        " WHERE a.sk_tempo IS NULL OR b.sk_tempo IS NULL")),
        21: (zero, _one("COUNT(*) FROM f_vendas WHERE valor_item IS NULL OR valor_item < 0")),
        22: (zero, _one("COUNT(*) FROM f_pedido WHERE prazo_entrega_dias < 0")),
        23: (zero, _one("COUNT(*) FROM f_pedido WHERE nota_avaliacao NOT BETWEEN 1 AND 5")),
        24: (zero, _one("COUNT(*) FROM f_pedido WHERE sk_tempo_entrega IS NULL AND prazo_entrega_dias IS NOT NULL")),
        25: (_one("COUNT(*) FROM s_products WHERE category IS NULL"),
             _one(f"COUNT(*) FROM d_produto WHERE categoria = '{v.NOT_INFORMED}'")),
        26: (_one(f"COUNT(*) FROM d_geografia WHERE origem = '{v.ORIGIN_TRANSACTIONS}'"),
             _one("COUNT(*) FROM d_geografia WHERE latitude_media IS NULL")),
    }
    for n, (dim, key) in enumerate(_DIMS.values(), 8):
        sides[n] = (zero, _one(_lost("f_vendas", key, dim, key)))
    unique = (("d_produto", "product_id"), ("d_vendedor", "seller_id"),
              ("d_cliente", "customer_unique_id"), ("d_geografia", "cep_prefixo"), ("d_tempo", "data"))
    for n, (dim, key) in enumerate(unique, 16):
        sides[n] = (zero, _one(f"COUNT(*) - COUNT(DISTINCT {key}) FROM {dim}"))
    rows = " UNION ALL ".join(
        f"SELECT {n} AS ordem, '{v.CHECK_TITLES[n]}' AS verificacao, {e} AS esperado, {o} AS obtido"
        for n, (e, o) in sorted(sides.items()))
    return f"SELECT *, CASE WHEN esperado = obtido THEN 'OK' ELSE 'FALHA' END AS situacao FROM ({rows}) q"


def _volumes() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, (SELECT COUNT(*) FROM {_RAW_VIEWS[t]}) AS carregados,"
        f" (SELECT COUNT(*) FROM {view}) AS esperado" for t, view in _RAW_VIEWS.items())
    return f"SELECT *, CASE WHEN carregados = esperado THEN 'OK' ELSE 'FALHA' END AS situacao FROM ({rows}) q"


def _coverage() -> str:
    conditions = ("qtd_itens > 0", "sk_pagamento <> 0", "nota_avaliacao IS NOT NULL",
                  "prazo_entrega_dias IS NOT NULL", "latitude_media IS NOT NULL")
    return " UNION ALL ".join(
        f"SELECT '{title}' AS cobertura, COUNT(*) FILTER (WHERE {c}) AS pedidos,"
        f" {pct(f'COUNT(*) FILTER (WHERE {c})', 'COUNT(*)')} AS percentual"
        f" FROM f_pedido JOIN d_geografia USING (sk_geografia)"
        for title, c in zip(v.COVERAGE_TITLES, conditions))


def _constraints() -> str:
    from armazem.plans import checks

    parts = []
    for name, key in checks.UNIQUE_KEYS:
        k = ", ".join(key)
        parts.append((f"unique {name} ({k})",
                      f"SELECT COALESCE(SUM(n - 1), 0) FROM (SELECT COUNT(*) AS n FROM {_WAREHOUSE[name]} GROUP BY {k}) q"))
    for name, columns in checks.MANDATORY.items():
        missing = " OR ".join(f"{c} IS NULL" for c in columns)
        parts.append((f"not null {name}", f"SELECT COUNT(*) FROM {_WAREHOUSE[name]} WHERE {missing}"))
    for key, name in checks.ORDER_REFERENCES:
        dim, dim_key = _DIMS[name]
        parts.append((f"foreign key fato_pedido ({key})",
                      f"SELECT {_lost('f_pedido', key, dim, dim_key)} AND f.{key} IS NOT NULL"))
    rows = " UNION ALL ".join(
        f"SELECT '{t}' AS restricao, CAST(({sql}) AS BIGINT) AS violacoes" for t, sql in parts)
    return f"SELECT *, CASE WHEN violacoes = 0 THEN 'OK' ELSE 'FALHA' END AS situacao FROM ({rows}) q"


VALIDATIONS = {
    "v01_staging_volume": _volumes(),
    "v02_table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, COUNT(*) AS registros FROM {view}" for t, view in _WAREHOUSE.items()),
    "v03_reconciliation": _checks(),
    "v04_coverage": _coverage(),
    "v05_gate": f"""
        SELECT falhas, CASE WHEN falhas > 0 THEN 1 ELSE 0 END AS codigo_saida
          FROM (SELECT COUNT(*) AS falhas FROM (SELECT situacao FROM ({_volumes()}) a
                UNION ALL SELECT situacao FROM ({_checks()}) b
                UNION ALL SELECT situacao FROM ({_constraints()}) k) c WHERE situacao = 'FALHA') d""",
    "v06_constraints": _constraints(),
}

# --- sources, functions and operators --------------------------------------------------------------

_LINE_MONEY = "CAST(l_extendedprice AS DECIMAL(12,2))"
PROBES = {
    "s01_csv_roundtrip": "SELECT conv_id, turn, role, text FROM conversations",
    "s01_split_csv": "SELECT doc_id, NULLIF(text, '') AS text, lang, source, n_chars FROM documents",
    "s03_required_inputs": " UNION ALL ".join(
        f"SELECT '{t.file_ending}' AS arquivo, '{name}' AS tabela_destino, {there} AS encontrado,"
        f" '{v.OK if there else v.FAILED}' AS situacao"
        for name, t in RAW_TABLES.items() for there in [name in ("sellers", "category_translation")]),
    "s02_header_check": """
        SELECT order_id, item AS order_item_id, product_id, seller_id, price, freight AS freight_value FROM s_items""",
    "s05_load_audit": " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, COUNT(*) AS registros_lidos, COUNT(*) AS registros_carregados,"
        f" TRUE AS em_ordem, '{v.LOAD_DONE}' AS situacao FROM {view}" for t, view in _RAW_VIEWS.items()),
    "s07_series": """
        SELECT ano_mes, COUNT(*) AS dias, CAST(SUM(sk_tempo) AS BIGINT) AS soma_chaves FROM d_tempo GROUP BY ano_mes""",
    "s09_export": f"SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({REPORTS['o01_rollup_calendar']}) r",
    "n01_normalize_label": f"SELECT doc_id, {label('text')} AS label FROM documents",
    "x19_quarantine": f"""
        SELECT * FROM (WITH i AS (SELECT (order_id * 7 + item) % 101 = 0 AS price, (order_id + item) % 103 = 0 AS freight FROM s_items),
             o AS (SELECT order_id % 97 = 0 AS bought FROM s_orders),
             n AS (SELECT 'order_items' AS tabela, COUNT(*) AS registros_lidos, COUNT(*) FILTER (NOT price AND NOT freight) AS registros_carregados,
                          COUNT(*) FILTER (price OR freight) AS registros_rejeitados FROM i
                   UNION ALL SELECT 'orders', COUNT(*), COUNT(*) FILTER (NOT bought), COUNT(*) FILTER (bought) FROM o),
             f AS (SELECT 'order_items' AS tabela, 'price' AS coluna, '{v.BAD_NUMBER}' AS motivo, COUNT(*) AS registros FROM i WHERE price
                   UNION ALL SELECT 'order_items', 'freight_value', '{v.BAD_NUMBER}', COUNT(*) FROM i WHERE freight
                   UNION ALL SELECT 'orders', 'order_purchase_timestamp', '{v.BAD_DATE}', COUNT(*) FROM o WHERE bought)
        SELECT * FROM f JOIN n USING (tabela)) q""",
    "x03_zip_prefix": "SELECT customer_id, lpad(trim(zip), 5, '0') AS cep_prefixo FROM s_customers",
    "x07_capitalize_words": f"SELECT page_id, {words('lower(url)')} AS words FROM pages",
    "x13_date_parts": f"""
        SELECT CAST(o_orderdate AS DATE) AS data, o_orderkey, {datekey('o_orderdate')} AS sk_tempo,
               CAST(day(o_orderdate) AS INTEGER) AS dia, CAST(month(o_orderdate) AS INTEGER) AS mes,
               ([{_list(v.MONTH_NAMES)}])[month(o_orderdate)] AS nome_mes,
               ([{_list(v.MONTH_SHORT)}])[month(o_orderdate)] AS mes_abrev,
               CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
               CAST(quarter(o_orderdate) AS VARCHAR) || 'T' || CAST(year(o_orderdate) AS VARCHAR) AS nome_trimestre,
               CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS semestre,
               CAST(year(o_orderdate) AS INTEGER) AS ano, strftime(o_orderdate, '%Y-%m') AS ano_mes,
               CAST(dayofweek(o_orderdate) AS INTEGER) AS dia_semana,
               ([{_list(v.WEEKDAY_NAMES)}])[dayofweek(o_orderdate) + 1] AS nome_dia_semana,
               dayofweek(o_orderdate) IN (0, 6) AS fim_de_semana
          FROM orders""",
    "x20_rounding_cast": f"""
        SELECT product_id, {nearest('weight')} AS arredondado, {nearest('-weight')} AS negativo,
               CAST(trunc(weight) AS INTEGER) AS truncado FROM s_products""",
    "a07_mode": """
        SELECT o_custkey, n, o_orderpriority, o_orderstatus
          FROM (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1) t
          JOIN (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey
                    ORDER BY COUNT(*) DESC, o_orderpriority) AS pos
                  FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2) a USING (o_custkey)
          JOIN (SELECT o_custkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey
                    ORDER BY COUNT(*) DESC, o_orderstatus) AS pos
                  FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1, 2) b USING (o_custkey)
         WHERE a.pos = 1 AND b.pos = 1""",
    "a09_composite_rollup": f"""
        SELECT ano, l_returnflag, l_linestatus, {total(f"SUM({_LINE_MONEY})")} AS valor, COUNT(*) AS linhas,
               CAST(GROUPING(ano) AS INTEGER) AS total_ano
          FROM (SELECT *, CAST(year(l_shipdate) AS INTEGER) AS ano FROM lineitem) l
         GROUP BY GROUPING SETS ((ano, l_returnflag, l_linestatus), (ano), ())""",
    "a10_cube": f"""
        SELECT l_returnflag, l_linestatus, l_linenumber, {total(f"SUM({_LINE_MONEY})")} AS valor, COUNT(*) AS linhas
          FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus, l_linenumber)""",
    "a15_first_per_key": """
        SELECT DISTINCT ON (l_orderkey) l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey FROM lineitem
         ORDER BY l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey""",
    "a16_nested_aggregate": f"""
        SELECT s_nationkey, COUNT(*) AS sellers, CAST(COALESCE(SUM(orders), 0) AS BIGINT) AS orders,
               {per('COALESCE(SUM(orders), 0)', 'COUNT(*)', 2)} AS per_seller
          FROM supplier LEFT JOIN (SELECT l_suppkey, COUNT(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1) q
               ON s_suppkey = l_suppkey GROUP BY s_nationkey""",
    "j03_full_join": """
        SELECT zip, COALESCE(customers, 0) AS customers, COALESCE(sellers, 0) AS sellers
          FROM (SELECT zip, COUNT(*) AS customers FROM s_customers GROUP BY zip) c
          FULL JOIN (SELECT zip, COUNT(*) AS sellers FROM s_sellers GROUP BY zip) s USING (zip)""",
    "j06_orphans": """
        SELECT o_orderstatus, COUNT(*) AS orders FROM orders
         WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY o_orderstatus""",
    "u01_union_all": f"""
        SELECT nation, COUNT(*) AS accounts, {total("SUM(CAST(balance AS DECIMAL(12,2)))")} AS balance
          FROM (SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer
                UNION ALL SELECT s_nationkey, s_acctbal FROM supplier) u GROUP BY nation""",
    "w02_rank": f"""
        SELECT CAST(rank AS INTEGER) AS rank, l_suppkey, {total('revenue')} AS revenue
          FROM (SELECT *, RANK() OVER (ORDER BY revenue DESC) AS rank
                  FROM (SELECT l_suppkey, SUM({_LINE_MONEY}) AS revenue FROM lineitem GROUP BY 1) q) r
         WHERE rank <= 50""",
    "w03_running_sum": """
        SELECT l_linenumber, l_quantity, lines, CAST(SUM(lines) OVER (ORDER BY lines DESC) AS BIGINT) AS running
          FROM (SELECT l_linenumber, l_quantity, COUNT(*) AS lines FROM lineitem GROUP BY 1, 2) q""",
    "l01_report_order": f"""
        SELECT row_number() OVER (ORDER BY regiao = '{v.GRAND_TOTAL}', regiao, estado = '{v.SUBTOTAL}', faturamento DESC, estado)
               AS posicao, regiao, estado FROM ({REPORTS['o02_region_state']}) r""",
    "l03_cube_order": f"""
        SELECT row_number() OVER (ORDER BY regiao = '{v.ALL_REGIONS}', regiao, tipo_pagamento = '{v.ALL_PAYMENTS}',
               faturamento DESC, tipo_pagamento) AS posicao, regiao, tipo_pagamento
          FROM ({REPORTS['o15_region_payment_cube']}) r""",
    "l02_missing_last": """
        SELECT * FROM (SELECT 'first' AS side, product_id, CAST(weight AS DECIMAL(12,1)) AS weight, 0::BIGINT AS place
                         FROM s_products ORDER BY weight DESC NULLS FIRST, product_id LIMIT 150) a
        UNION ALL
        SELECT 'last', product_id, CAST(weight AS DECIMAL(12,1)), RANK() OVER (ORDER BY weight ASC NULLS LAST)
          FROM s_products""",
    "w04_two_rankings": f"""
        SELECT p_brand, {total('revenue')} AS revenue, CASE WHEN best <= 3 THEN 'best' ELSE 'worst' END AS side
          FROM (SELECT *, RANK() OVER (ORDER BY revenue DESC) AS best, RANK() OVER (ORDER BY revenue) AS worst
                  FROM (SELECT p_brand, SUM({_LINE_MONEY}) AS revenue
                          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) q) r
         WHERE best <= 3 OR worst <= 3""",
}


def all_queries() -> dict[str, str]:
    plain = REPORTS | FEEDS | {"k01_kpis": KPIS} | LOADS | VALIDATIONS | PROBES
    return {name: with_views(sql) for name, sql in plain.items()}
