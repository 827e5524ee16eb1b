"""Labels, lookup tables and formats that reports must reproduce exactly."""

# --- calendar labels -------------------------------------------------------------------
MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho", "Agosto",
    "Setembro", "Outubro", "Novembro", "Dezembro",
)
MONTH_SHORT = ("Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez")
WEEKDAY_NAMES = (
    "Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira",
    "Sexta-feira", "Sábado",
)

# --- text normalisation ----------------------------------------------------------------
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñ"
UNACCENTED = "aaaaaeeeeiiiiooooouuuucn"
LOWERCASE_PARTICLES = ("Do", "Da", "De", "Dos", "Das", "E")

# --- order status: code, label, delivered, cancelled, position in the life cycle ---------
ORDER_STATUS = (
    ("created", "Criado", False, False, 1),
    ("approved", "Aprovado", False, False, 2),
    ("invoiced", "Faturado", False, False, 3),
    ("processing", "Em processamento", False, False, 4),
    ("shipped", "Enviado", False, False, 5),
    ("delivered", "Entregue", True, False, 6),
    ("unavailable", "Indisponível", False, False, 7),
    ("canceled", "Cancelado", False, True, 8),
)
UNLISTED_STATUS_POSITION = 99

# --- payments ---------------------------------------------------------------------------
PAYMENT_LABELS = (
    ("credit_card", "Cartão de crédito"),
    ("boleto", "Boleto"),
    ("voucher", "Voucher"),
    ("debit_card", "Cartão de débito"),
    ("not_defined", "Não definido"),
)
INSTALMENT_BANDS = (
    (1, "À vista"),
    (3, "2 a 3 parcelas"),
    (6, "4 a 6 parcelas"),
    (12, "7 a 12 parcelas"),
)
INSTALMENTS_ABOVE = "Acima de 12 parcelas"
UNKNOWN_PAYMENT_CODE = "nao_informado"

# --- products ---------------------------------------------------------------------------
WEIGHT_BANDS = (
    (500, "Até 500 g"),
    (2000, "501 g a 2 kg"),
    (10000, "2 kg a 10 kg"),
)
WEIGHT_ABOVE = "Acima de 10 kg"
UNKNOWN_CATEGORY_CODE = "nao_informado"

# --- shared labels ------------------------------------------------------------------------
NOT_INFORMED = "Não informado"
NOT_INFORMED_EN = "Not informed"
GRAND_TOTAL = "Total geral"
SUBTOTAL = "(subtotal)"
ALL_REGIONS = "Todas as regiões"
ALL_PAYMENTS = "Todos os tipos"
LEVELS = ("Geral", "Ano", "Trimestre", "Mês")
BEST, WORST = "Melhores", "Piores"
OK, FAILED = "OK", "FALHA"
LOAD_DONE, LOAD_DIVERGED = "CONCLUIDA", "DIVERGENTE"
LOAD_RUNNING, LOAD_FAILED = "EM ANDAMENTO", "ERRO"
BAD_NUMBER, BAD_DATE, BAD_WIDTH = "numero invalido", "data invalida", "numero de campos invalido"
ORIGIN_GEOLOCATION = "geolocation"
ORIGIN_TRANSACTIONS = "clientes/vendedores"

# --- delivery bands, by days after the due date -------------------------------------------
DELIVERY_EARLY = "1. Entregue antes da data estimada"
DELIVERY_ON_TIME = "2. Entregue na data estimada"
DELIVERY_LATE_BANDS = ((7, "3. Atraso de 1 a 7 dias"), (15, "4. Atraso de 8 a 15 dias"))
DELIVERY_LATE_ABOVE = "5. Atraso acima de 15 dias"
DELIVERY_MISSING = "6. Não entregue"

# --- bounding box of the served territory, in degrees --------------------------------------
LATITUDE_RANGE = ("-33.75", "5.27")
LONGITUDE_RANGE = ("-73.99", "-34.79")

# --- state code, name, region ----------------------------------------------------------------
STATES = (
    ("AC", "Acre", "Norte"),
    ("AL", "Alagoas", "Nordeste"),
    ("AM", "Amazonas", "Norte"),
    ("AP", "Amapá", "Norte"),
    ("BA", "Bahia", "Nordeste"),
    ("CE", "Ceará", "Nordeste"),
    ("DF", "Distrito Federal", "Centro-Oeste"),
    ("ES", "Espírito Santo", "Sudeste"),
    ("GO", "Goiás", "Centro-Oeste"),
    ("MA", "Maranhão", "Nordeste"),
    ("MG", "Minas Gerais", "Sudeste"),
    ("MS", "Mato Grosso do Sul", "Centro-Oeste"),
    ("MT", "Mato Grosso", "Centro-Oeste"),
    ("PA", "Pará", "Norte"),
    ("PB", "Paraíba", "Nordeste"),
    ("PE", "Pernambuco", "Nordeste"),
    ("PI", "Piauí", "Nordeste"),
    ("PR", "Paraná", "Sul"),
    ("RJ", "Rio de Janeiro", "Sudeste"),
    ("RN", "Rio Grande do Norte", "Nordeste"),
    ("RO", "Rondônia", "Norte"),
    ("RR", "Roraima", "Norte"),
    ("RS", "Rio Grande do Sul", "Sul"),
    ("SC", "Santa Catarina", "Sul"),
    ("SE", "Sergipe", "Nordeste"),
    ("SP", "São Paulo", "Sudeste"),
    ("TO", "Tocantins", "Norte"),
)
REGIONS = ("Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul")

# --- published record counts of the raw files ---------------------------------------------------
EXPECTED_VOLUMES = (
    ("orders", 99441),
    ("order_items", 112650),
    ("order_payments", 103886),
    ("order_reviews", 99224),
    ("customers", 99441),
    ("products", 32951),
    ("sellers", 3095),
    ("geolocation", 1000163),
    ("category_translation", 71),
)

# --- titles of the reconciliation checks -----------------------------------------------------------
CHECK_TITLES = {
    1: "Itens de pedido na origem = linhas da fato_vendas",
    2: "Pedidos na origem = linhas da fato_pedido",
    3: "Soma de price (origem) = soma de valor_item (fato_vendas)",
    4: "Soma de freight_value (origem) = soma de valor_frete (fato_vendas)",
    5: "Soma de payment_value (origem) = soma de valor_pago (fato_pedido)",
    6: "Pedidos distintos na fato_vendas = pedidos com itens na origem",
    7: "Pedidos cujo valor de itens difere entre fato_vendas e fato_pedido",
    8: "fato_vendas sem dim_tempo",
    9: "fato_vendas sem dim_cliente",
    10: "fato_vendas sem dim_produto",
    11: "fato_vendas sem dim_vendedor",
    12: "fato_vendas sem dim_geografia",
    13: "fato_vendas sem dim_pagamento",
    14: "fato_vendas sem dim_status",
    15: "fato_pedido sem dim_tempo (compra ou estimada)",
    16: "product_id duplicado em dim_produto",
    17: "seller_id duplicado em dim_vendedor",
    18: "customer_unique_id duplicado em dim_cliente",
    19: "cep_prefixo duplicado em dim_geografia",
    20: "data duplicada em dim_tempo",
    21: "Itens com valor_item nulo ou negativo",
    22: "Pedidos entregues com prazo de entrega negativo",
    23: "Notas de avaliacao fora do intervalo 1 a 5",
    24: "Pedidos nao entregues com prazo preenchido",
    25: 'Produtos sem categoria tratados como "Nao informado"',
    26: "Prefixos de CEP de clientes/vendedores sem coordenadas (tratados na dim_geografia)",
}
COVERAGE_TITLES = (
    "Pedidos com itens",
    "Pedidos com pagamento registrado",
    "Pedidos com avaliacao",
    "Pedidos entregues (com prazo calculado)",
    "Pedidos com coordenadas geograficas",
)
