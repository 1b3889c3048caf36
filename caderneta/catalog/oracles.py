"""Check SQL on the source tables, one statement per registered query.

None of it looks at printed lines or grids: each statement restates the rule on
``lineitem`` and its dimensions.
"""

from __future__ import annotations

UNIT = "CASE l_returnflag WHEN 'A' THEN 'UN' WHEN 'N' THEN 'PC' WHEN 'R' THEN 'KG' END"

SOLD = """sold AS (
  SELECT * FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

PRODUCT = "printf('%06d', l_partkey) || ' - ' || p_name"
DOCUMENT = "'001-' || printf('%06d', l_orderkey)"

# Items as the adapters give them, standardised; copies of every tenth order.
ITEMS = f"""{SOLD},
base AS (
  SELECT {PRODUCT} AS produto,
    CASE WHEN l_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) END AS data_emissao,
    '001' AS tipo_documento,
    {DOCUMENT} AS numero_documento,
    CAST(l_linenumber AS VARCHAR) AS protocolo,
    l_extendedprice AS valor_total_venda,
    l_quantity AS quantidade,
    {UNIT} AS unidade_medida,
    s_name AS responsavel,
    p_type AS artigo,
    CAST(year(l_shipdate) AS VARCHAR) || '.xlsx' AS arquivo,
    l_orderkey AS chave,
    printf('%06d', l_partkey) AS codigo_produto,
    p_name AS descricao_produto
  FROM sold
),
named AS (
  SELECT produto, data_emissao, tipo_documento, numero_documento, protocolo,
    valor_total_venda, quantidade, unidade_medida, responsavel, artigo,
    codigo_produto, descricao_produto,
    tipo_documento || numero_documento
      || coalesce(CAST(data_emissao AS VARCHAR), 'None') AS id_venda,
    tipo_documento || numero_documento
      || coalesce(CAST(data_emissao AS VARCHAR), 'None') || protocolo AS id_item_venda,
    arquivo, chave
  FROM base
),
items AS (
  SELECT * EXCLUDE (arquivo, chave), arquivo AS arquivo_origem FROM named
  UNION ALL
  SELECT * EXCLUDE (arquivo, chave), 'zz_copy.xlsx' AS arquivo_origem FROM named
  WHERE chave % 10 = 0
)"""

ITEM_COLUMNS = """produto, data_emissao, tipo_documento, numero_documento, protocolo,
    valor_total_venda, quantidade, unidade_medida, responsavel, artigo,
    codigo_produto, descricao_produto, id_venda, id_item_venda"""

CLEAN = f"""{ITEMS},
clean AS (
  SELECT {ITEM_COLUMNS}, min(arquivo_origem) AS arquivo_origem
  FROM items GROUP BY ALL
)"""

# The same rows with the date as text, which both engines print alike.
TEXT_DATE = "* REPLACE (CAST(data_emissao AS VARCHAR) AS data_emissao)"

# --- printed lines -------------------------------------------------------------

FILE = "'vendas_' || l_returnflag || '.rel'"
ITEM_CODE = "printf('%06d', l_partkey % 1000000)"
ORDER = """l_linenumber // 6, l_orderkey // 4096, l_partkey // 1048576,
    l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, l_shipdate"""


def br(number: str) -> str:
    return f"replace(replace(replace(format('{{:,.2f}}', {number}), ',', '#'), '.', ','), '#', '.')"


# Lines that survive the furniture marks (a marked description is lost).
DOCS = f"""docs AS (
  SELECT {FILE} AS arquivo_origem,
    {ITEM_CODE} AS codigo_item,
    CASE WHEN l_orderkey % 103 = 0 THEN '' ELSE p_name || ' peça' END AS descricao,
    l_quantity AS quantidade, {UNIT} AS unidade_medida,
    CAST(l_linenumber * 7 AS DOUBLE) AS qtd_estoque,
    l_extendedprice AS valor,
    l_orderkey + 10005 AS ci,
    2 + (20 * l_orderkey) // ((SELECT max(o_orderkey) FROM orders) + 1)
      - CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END AS yy,
    CASE WHEN l_linenumber % 3 = 0 THEN l_shipdate ELSE o_orderdate END AS dia_de,
    row_number() OVER (PARTITION BY l_returnflag ORDER BY {ORDER}) AS pos,
    l_orderkey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  WHERE l_orderkey % 101 <> 0
)"""

ANALYTIC = f"""{DOCS},
lines AS (
  SELECT *,
    CASE WHEN l_orderkey % 89 = 0 THEN 31 ELSE day(dia_de) END AS dia,
    CASE WHEN l_orderkey % 89 = 0 THEN 2 ELSE month(dia_de) END AS mes,
    2000 + yy AS ano_impresso
  FROM docs WHERE descricao <> ''
),
years AS (
  SELECT *, max(ano_impresso) OVER (
    PARTITION BY arquivo_origem ORDER BY ci, pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ano
  FROM lines
),
dated AS (
  SELECT *, try_cast(printf('%04d-%02d-%02d', CAST(ano AS INT), CAST(mes AS INT),
    CAST(dia AS INT)) AS DATE) AS data_emissao
  FROM years
),
sales AS (
  SELECT *, row_number() OVER (PARTITION BY arquivo_origem, ci ORDER BY pos) AS n
  FROM dated WHERE data_emissao IS NOT NULL
)"""

PURCHASE = f"""{DOCS},
lines AS (
  SELECT *,
    CASE WHEN l_orderkey % 23 = 0 THEN 1 WHEN l_orderkey % 89 = 0 THEN 31
      ELSE day(dia_de) END AS dia,
    CASE WHEN l_orderkey % 23 = 0 THEN 1 WHEN l_orderkey % 89 = 0 THEN 2
      ELSE month(dia_de) END AS mes,
    CASE WHEN l_orderkey % 23 = 0 THEN 19 ELSE yy END AS aa
  FROM docs
),
by_date AS (
  SELECT arquivo_origem, ci, dia, mes, aa, count(*) AS n, min(pos) AS primeira
  FROM lines GROUP BY ALL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY arquivo_origem, ci ORDER BY n DESC, primeira) AS r,
    sum(n) OVER (PARTITION BY arquivo_origem, ci) AS total_datas
  FROM by_date
),
modal AS (
  SELECT arquivo_origem, ci, dia, mes, aa,
    printf('%02d/%02d/%02d', CAST(dia AS INT), CAST(mes AS INT), CAST(aa AS INT))
      AS data_original,
    n AS freq_data, CAST(total_datas AS BIGINT) AS total_datas
  FROM ranked WHERE r = 1
),
span AS (
  SELECT arquivo_origem, min(ci) AS ci_min,
    CAST(max(ci) - min(ci) AS DOUBLE) / CAST(18 AS DOUBLE) AS w
  FROM modal GROUP BY ALL
),
sliced AS (
  SELECT modal.*, 2005 + {" + ".join(
      f"CASE WHEN ci >= ci_min + CAST({k} AS DOUBLE) * w THEN 1 ELSE 0 END"
      for k in range(1, 18))} AS ano_inferido
  FROM modal JOIN span USING (arquivo_origem)
),
resolved AS (
  SELECT *,
    CASE WHEN data_original = '01/01/19' THEN 'Baixa'
      WHEN 2 * freq_data < total_datas THEN 'Media'
      WHEN 2000 + aa = ano_inferido THEN 'Alta' ELSE 'Media' END AS confianca,
    CASE WHEN data_original = '01/01/19' THEN make_date(ano_inferido, 1, 1)
      ELSE coalesce(
        try_cast(printf('%04d-%02d-%02d', CAST(ano_inferido AS INT), CAST(mes AS INT),
          CAST(dia AS INT)) AS DATE),
        make_date(ano_inferido, 1, 1)) END AS data_emissao
  FROM sliced
)"""

# The same lines as one report, a document's lines file after file.
ONE_FILE = PURCHASE.replace(f"{FILE} AS arquivo_origem", "'' AS arquivo_origem").replace(
    "PARTITION BY l_returnflag ORDER BY", "ORDER BY l_returnflag,"
)

# --- grids ---------------------------------------------------------------------

GRID = f"""{SOLD},
grid_items AS (
  SELECT {PRODUCT} AS produto,
    CAST(CASE WHEN l_orderkey % 97 <> 0 AND l_orderkey % 89 <> 0
      THEN CAST(o_orderdate AS DATE) END AS VARCHAR) AS data_emissao,
    '001' AS tipo_documento,
    {DOCUMENT} AS numero_documento,
    CAST(CASE WHEN l_orderkey % 13 = 0 THEN 20250000000000000 + l_linenumber
      ELSE l_linenumber END AS VARCHAR) AS protocolo,
    CASE WHEN l_orderkey % 83 = 0 THEN 0.0 ELSE l_extendedprice END AS valor_total_venda,
    l_quantity AS quantidade,
    {UNIT} AS unidade_medida,
    CASE WHEN l_suppkey % 77 = 0 THEN 'IGNORADO' ELSE s_name END AS responsavel,
    p_type AS artigo,
    CAST(year(l_shipdate) AS VARCHAR) || '.xlsx' AS arquivo_origem
  FROM sold
),
flat_items AS (
  SELECT {PRODUCT} AS produto,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data_emissao,
    '001' AS tipo_documento,
    {DOCUMENT} AS numero_documento,
    CAST(l_linenumber + 7000000 AS VARCHAR) AS protocolo,
    l_extendedprice AS valor_total_venda,
    l_quantity AS quantidade,
    {UNIT} AS unidade_medida,
    'legado_' || CAST(year(l_shipdate) AS VARCHAR) || '.xls' AS arquivo_origem
  FROM sold WHERE l_orderkey % 97 <> 0 AND l_orderkey % 89 <> 0
)"""

# --- KPIs ------------------------------------------------------------------------

MONTH = "coalesce(strftime(data_emissao, '%Y-%m'), 'NaT')"
TOP_VALUE = """SELECT codigo_produto AS codigo, descricao_produto AS descricao,
    round(sum(valor_total_venda), 2) AS total
  FROM clean GROUP BY ALL ORDER BY total DESC, codigo, descricao LIMIT 10"""
TOP_QUANTITY = TOP_VALUE.replace("sum(valor_total_venda)", "sum(quantidade)")
BY_MONTH = f"""SELECT {MONTH} AS mes, round(sum(valor_total_venda), 2) AS total
  FROM clean GROUP BY ALL"""
GLOBAL = """SELECT round(sum(valor_total_venda), 2) AS total_faturamento,
    count(DISTINCT id_venda) AS qtd_notas_fiscais, count(*) AS total_itens,
    round(sum(valor_total_venda) / count(DISTINCT id_venda), 2) AS ticket_medio
  FROM clean"""
KPIS = f"""{CLEAN},
g AS ({GLOBAL}),
v AS ({TOP_VALUE}),
q AS ({TOP_QUANTITY}),
m AS ({BY_MONTH})"""


def money(number: str) -> str:
    return f"'R$ ' || replace(format('{{:,.2f}}', {number}), ',', '_')"


def whole(number: str) -> str:
    return f"replace(format('{{:,}}', CAST({number} AS BIGINT)), ',', '_')"


def _text_lines(section: int, texts: list[str]) -> str:
    rows = [f"SELECT {section} AS s, {i} AS p, '{text}' AS line" for i, text in enumerate(texts)]
    return " UNION ALL ".join(rows)


RANKING_HEAD = ["| # | Código | Descrição | Total |", "|---|--------|-----------|------:|"]
REPORT = f"""WITH {KPIS},
lines AS (
  {_text_lines(0, ["# Relatório de KPIs", "", "## Métricas Globais", "",
                   "| Métrica | Valor |", "|---------|------:|"])}
  UNION ALL SELECT 0, 10, '| Faturamento total | ' || {money("total_faturamento")} || ' |' FROM g
  UNION ALL SELECT 0, 11, '| Notas fiscais | ' || {whole("qtd_notas_fiscais")} || ' |' FROM g
  UNION ALL SELECT 0, 12, '| Itens vendidos | ' || {whole("total_itens")} || ' |' FROM g
  UNION ALL SELECT 0, 13, '| Ticket médio | ' || {money("ticket_medio")} || ' |' FROM g
  UNION ALL {_text_lines(1, ["", "## Top Produtos (por valor)", "", *RANKING_HEAD])}
  UNION ALL SELECT 1, 9 + n, '| ' || n || ' | ' || codigo || ' | ' || descricao[1:60] || ' | '
    || {money("total")} || ' |'
    FROM (SELECT *, row_number() OVER (ORDER BY total DESC, codigo, descricao) AS n FROM v)
  UNION ALL {_text_lines(2, ["", "## Top Produtos (por quantidade)", "", *RANKING_HEAD])}
  UNION ALL SELECT 2, 9 + n, '| ' || n || ' | ' || codigo || ' | ' || descricao[1:60] || ' | '
    || {whole("total")} || ' |'
    FROM (SELECT *, row_number() OVER (ORDER BY total DESC, codigo, descricao) AS n FROM q)
  UNION ALL {_text_lines(3, ["", "## Vendas por Mês", "", "| Mês | Total |", "|-----|------:|"])}
  UNION ALL SELECT 3, 9 + row_number() OVER (ORDER BY mes), '| ' || mes || ' | '
    || {money("total")} || ' |' FROM m
  UNION ALL {_text_lines(9, [""])}
)
SELECT row_number() OVER (ORDER BY s, p) AS ord, line FROM lines"""

STAGES = f"""{CLEAN},
n AS (SELECT (SELECT count(*) FROM items) AS o, (SELECT count(*) FROM clean) AS f)"""

CSV_NAMES = [
    "produto", "data_emissao", "tipo_documento", "numero_documento", "protocolo",
    "valor_total_venda", "quantidade", "unidade_medida", "responsavel", "artigo",
    "arquivo_origem", "codigo_produto", "descricao_produto", "id_venda", "id_item_venda",
]
NUMERIC = ("valor_total_venda", "quantidade")


def _csv_field(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    return text if name in NUMERIC else f"'\"' || coalesce({text}, '') || '\"'"


def _json_field(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    if name not in NUMERIC:
        text = f"'\"' || coalesce({text}, 'None') || '\"'"
    return f"'\"{name}\":' || {text}"


CSV_HEADER = ",".join(f'"{n}"' for n in CSV_NAMES)
CSV_LINE = " || ',' || ".join(_csv_field(n) for n in CSV_NAMES)
JSON_LINE = "'{' || " + " || ',' || ".join(_json_field(n) for n in CSV_NAMES) + " || '}'"

PLAIN = "aaaaeeioooucAAAAEEIOOOUC"
ACCENTED = "áàãâéêíóôõúçÁÀÃÂÉÊÍÓÔÕÚÇ"

PRINTED_DATE = """CASE WHEN l_orderkey % 89 = 0 THEN '31/02/' ELSE strftime(dia_de, '%d/%m/') END
    || printf('%02d', CAST(yy AS INT))"""

CLEAN_ROWS = f"WITH {CLEAN} SELECT {TEXT_DATE} FROM clean"

ORACLES: dict[str, str] = {
    # sources
    "rel_line_scan": f"""WITH {DOCS}
      SELECT codigo_item || rpad(descricao, 60, ' ')
        || lpad(CAST(CAST(qtd_estoque AS INT) AS VARCHAR), 5, ' ')
        || rpad(unidade_medida, 3, ' ') || '      ' || lpad({br("quantidade")}, 12, ' ')
        || lpad({PRINTED_DATE}, 10, ' ') || lpad(CAST(ci AS VARCHAR), 14, ' ')
        || lpad({br("valor")}, 16, ' ') AS line
      FROM docs
      UNION ALL
      SELECT rpad('Item   Artigo', 132, ' ') FROM lineitem WHERE l_orderkey % 50 = 0""",
    "rows_per_source": """
      SELECT 'lineitem.parquet' AS arquivo_origem, count(*) AS linhas FROM lineitem
      UNION ALL SELECT 'orders.parquet', count(*) FROM orders
      UNION ALL SELECT 'part.parquet', count(*) FROM part
      UNION ALL SELECT 'supplier.parquet', count(*) FROM supplier""",
    "ingest_union": f"""WITH {GRID}
      SELECT * FROM grid_items UNION ALL BY NAME SELECT * FROM flat_items""",
    "incremental_ingest": f"""WITH {GRID}
      SELECT * FROM grid_items UNION ALL BY NAME SELECT * FROM flat_items""",
    "streamed_ingest": f"""WITH {GRID}
      SELECT * FROM grid_items UNION ALL BY NAME SELECT * FROM flat_items""",
    "layout_dispatch": f"""WITH {GRID}
      SELECT upper(arquivo_origem) AS arquivo_origem, 'hierarquico' AS layout,
        count(*) AS linhas FROM grid_items GROUP BY ALL
      UNION ALL
      SELECT upper(arquivo_origem), 'plano', count(*) FROM flat_items GROUP BY ALL""",
    # grids
    "hier_flatten": f"WITH {GRID} SELECT * FROM grid_items",
    "hier_filldown": f"""WITH {GRID}
      SELECT arquivo_origem, responsavel, artigo, count(*) AS linhas,
        round(sum(valor_total_venda), 2) AS valor
      FROM grid_items GROUP BY ALL""",
    "heading_class_counts": f"""WITH {SOLD},
      blocks AS (
        SELECT DISTINCT CAST(year(l_shipdate) AS VARCHAR) || '.xlsx' AS arquivo_origem,
          l_suppkey AS s, p_type FROM sold),
      kinds AS (
        SELECT arquivo_origem, unnest(['R', 'A', 'T', 'T']
          || CASE WHEN s % 7 = 0 THEN ['A'] ELSE [] END
          || CASE WHEN s % 11 = 0 THEN ['R'] ELSE ['P'] END
          || CASE WHEN s % 5 = 0 THEN ['X'] ELSE [] END) AS kind FROM blocks
        UNION ALL
        SELECT CAST(year(l_shipdate) AS VARCHAR) || '.xlsx', 'X' FROM sold)
      SELECT arquivo_origem, kind, count(*) AS linhas FROM kinds GROUP BY ALL""",
    "flat_grid_extract": f"WITH {GRID} SELECT * FROM flat_items",
    # printed reports
    "rel_synth_filter": f"""
      SELECT {FILE} AS arquivo_origem,
        CAST(count(*) FILTER (l_orderkey % 101 <> 0)
          + 3 * count(*) FILTER (l_orderkey % 50 = 0) AS BIGINT) AS linhas
      FROM lineitem GROUP BY ALL""",
    "rel_synth_items": f"""
      SELECT {FILE} AS arquivo_origem, {ITEM_CODE} AS codigo_item, p_name || ' peça' AS descricao,
        l_quantity AS quantidade, {UNIT} AS unidade_medida,
        CAST(l_linenumber * 7 AS DOUBLE) AS qtd_estoque,
        CAST(format('{{:.2f}}', l_extendedprice / 2) AS DOUBLE) AS total_custo,
        l_extendedprice AS valor_total_venda,
        round(l_tax * 100, 2) AS total_liquido,
        p_size + CAST(0.25 AS DOUBLE) AS margem_pct,
        {ITEM_CODE} || ' - ' || p_name || ' peça' AS produto,
        CAST(NULL AS VARCHAR) AS data_emissao,
        '' AS tipo_documento, '' AS numero_documento, '' AS protocolo
      FROM lineitem JOIN part ON l_partkey = p_partkey
      WHERE l_orderkey % 101 <> 0 AND l_orderkey % 103 <> 0""",
    "rel_sales_items": f"""WITH {ANALYTIC}
      SELECT arquivo_origem, codigo_item, descricao, quantidade, unidade_medida, qtd_estoque,
        valor AS valor_total_venda, CAST(data_emissao AS VARCHAR) AS data_emissao, ci,
        codigo_item || ' - ' || descricao AS produto, 'CI' AS tipo_documento,
        CAST(ci AS VARCHAR) AS numero_documento, CAST(n AS VARCHAR) AS protocolo,
        '' AS responsavel, '' AS artigo
      FROM sales""",
    "ci_running_year": f"""WITH {ANALYTIC}
      SELECT arquivo_origem, ci, ano_impresso, ano, count(*) AS linhas FROM years GROUP BY ALL""",
    "ci_item_sequence": f"""WITH {ANALYTIC}
      SELECT arquivo_origem, ci, codigo_item, CAST(n AS VARCHAR) AS protocolo,
        valor AS valor_total_venda FROM sales""",
    "rel_purchase_lines": f"""WITH {PURCHASE}
      SELECT arquivo_origem, codigo_item, descricao, quantidade, unidade_medida, qtd_estoque,
        valor, dia, mes, aa, ci FROM lines""",
    "ci_group_stats": f"""WITH {PURCHASE}
      SELECT arquivo_origem, ci, count(*) AS n_itens, round(sum(valor), 2) AS total_compra,
        count(DISTINCT codigo_item) AS itens_distintos, count(*) AS total_datas
      FROM lines GROUP BY ALL""",
    "ci_modal_date": f"""WITH {PURCHASE}
      SELECT arquivo_origem, ci, data_original, freq_data, total_datas FROM modal""",
    "ci_year_slices": f"""WITH {PURCHASE}
      SELECT arquivo_origem, ci, CAST(ano_inferido AS BIGINT) AS ano_inferido FROM sliced""",
    "date_confidence": f"""WITH {PURCHASE}
      SELECT arquivo_origem, CAST(ano_inferido AS BIGINT) AS ano_inferido, confianca,
        count(*) AS documentos FROM resolved GROUP BY ALL""",
    "purchase_dates": f"""WITH {PURCHASE}
      SELECT arquivo_origem, ci, CAST(ano_inferido AS BIGINT) AS ano_inferido,
        CAST(data_emissao AS VARCHAR) AS data_emissao FROM resolved""",
    "rel_file_purchases": f"""WITH {ONE_FILE}
      SELECT codigo_item, descricao, quantidade, unidade_medida, qtd_estoque, ci, data_original,
        codigo_item || ' - ' || descricao AS produto, 'CI-Compra' AS tipo_documento,
        CAST(ci AS VARCHAR) AS numero_documento,
        CAST(row_number() OVER (PARTITION BY ci ORDER BY pos) AS VARCHAR) AS protocolo,
        valor AS valor_total_venda, '' AS responsavel, '' AS artigo
      FROM lines JOIN (SELECT ci, data_original FROM modal) USING (ci)""",
    "rel_purchase_items": f"""WITH {PURCHASE}
      SELECT arquivo_origem, codigo_item, descricao, quantidade, unidade_medida, qtd_estoque,
        ci, CAST(ano_inferido AS BIGINT) AS ano_inferido, confianca, data_original,
        codigo_item || ' - ' || descricao AS produto, 'CI-Compra' AS tipo_documento,
        CAST(ci AS VARCHAR) AS numero_documento,
        CAST(row_number() OVER (PARTITION BY arquivo_origem, ci ORDER BY pos) AS VARCHAR)
          AS protocolo,
        CAST(data_emissao AS VARCHAR) AS data_emissao, valor AS valor_total_venda,
        '' AS responsavel, '' AS artigo
      FROM lines
      JOIN (SELECT arquivo_origem, ci, ano_inferido, confianca, data_original, data_emissao
            FROM resolved) USING (arquivo_origem, ci)""",
    # standardise, validate, consolidate
    "split_product": """
      SELECT CASE WHEN l_partkey % 7 = 0 OR l_partkey % 11 = 0 THEN ''
          ELSE CAST(l_partkey AS VARCHAR) END AS codigo_produto,
        CASE WHEN l_partkey % 7 = 0 THEN p_name WHEN l_partkey % 11 = 0 THEN ''
          ELSE p_name || ' - ' || p_brand END AS descricao_produto,
        count(*) AS linhas
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "standardize": f"WITH {ITEMS} SELECT {TEXT_DATE} FROM items",
    "required_field_violations": f"""WITH {ITEMS}
      SELECT 'produto' AS campo, count(*) FILTER (coalesce(trim(produto), '') = '') AS vazios
        FROM items
      UNION ALL SELECT 'data_emissao', count(*) FILTER (data_emissao IS NULL) FROM items
      UNION ALL SELECT 'numero_documento',
        count(*) FILTER (coalesce(trim(numero_documento), '') = '') FROM items
      UNION ALL SELECT 'valor_total_venda', count(*) FILTER (valor_total_venda IS NULL)
        FROM items""",
    "duplicate_sales_ids": f"""WITH {ITEMS}
      SELECT id_venda, count(*) AS ocorrencias FROM items GROUP BY ALL HAVING count(*) > 1""",
    "validation_report": f"""WITH {ITEMS},
      c AS (SELECT count(*) AS linhas, count(*) FILTER (data_emissao IS NULL) AS vazios,
              count(*) - count(DISTINCT id_venda) AS repetidos FROM items),
      e AS (SELECT linhas, list_filter([
              CASE WHEN vazios > 0 THEN 'Campo obrigatório vazio: data_emissao' END,
              CASE WHEN repetidos > 0 THEN 'Duplicatas encontradas em id_venda' END],
              lambda x: x IS NOT NULL) AS erros FROM c)
      SELECT linhas AS total_rows, len(erros) > 0 AS has_errors,
        CAST(len(erros) AS BIGINT) AS total_errors,
        CASE WHEN len(erros) = 0 THEN 'OK - ' || linhas || ' linhas, 0 erros'
          ELSE len(erros) || ' erro(s) em ' || linhas || ' linhas: '
            || array_to_string(erros, '; ') END AS summary
      FROM e""",
    "validation_missing_column": f"""WITH {ITEMS},
      found AS (
        SELECT 1 AS k, 'Campo obrigatório vazio: data_emissao' AS error
          WHERE EXISTS (SELECT 1 FROM items WHERE data_emissao IS NULL)
        UNION ALL SELECT 2, 'Campo obrigatório ausente: numero_documento'
        UNION ALL SELECT 3, 'Duplicatas encontradas em id_venda'
          WHERE EXISTS (SELECT 1 FROM items GROUP BY id_venda HAVING count(*) > 1))
      SELECT row_number() OVER (ORDER BY k) - 1 AS ord, error FROM found""",
    "quarantined_items": f"""WITH {ITEMS},
      changed AS (SELECT * REPLACE (
          CASE WHEN protocolo = '3' THEN ' ' ELSE numero_documento END AS numero_documento,
          CASE WHEN protocolo = '5' THEN NULL ELSE valor_total_venda END AS valor_total_venda),
          count(*) OVER (PARTITION BY id_venda) AS vezes FROM items),
      judged AS (SELECT valor_total_venda, concat_ws('; ',
          CASE WHEN coalesce(trim(produto), '') = ''
            THEN 'Campo obrigatório vazio: produto' END,
          CASE WHEN data_emissao IS NULL THEN 'Campo obrigatório vazio: data_emissao' END,
          CASE WHEN coalesce(trim(numero_documento), '') = ''
            THEN 'Campo obrigatório vazio: numero_documento' END,
          CASE WHEN valor_total_venda IS NULL
            THEN 'Campo obrigatório vazio: valor_total_venda' END,
          CASE WHEN vezes > 1 THEN 'Duplicatas encontradas em id_venda' END) AS motivos
        FROM changed)
      SELECT CASE WHEN motivos = '' THEN 'aceito' ELSE 'rejeitado' END AS situacao, motivos,
        count(*) AS linhas, round(sum(valor_total_venda), 2) AS valor
      FROM judged GROUP BY ALL""",
    "consolidate": CLEAN_ROWS,
    "consolidation_report": f"""WITH {STAGES}
      SELECT o AS total_original, f AS total_final, o - f AS linhas_removidas FROM n""",
    # KPIs
    "kpi_global": f"WITH {KPIS} SELECT * FROM g",
    "top_products_value": f"WITH {KPIS} SELECT * FROM v",
    "top_products_qty": f"WITH {KPIS} SELECT * FROM q",
    "sales_by_month": f"WITH {KPIS} SELECT * FROM m",
    "kpi_bundle": f"""WITH {KPIS}
      SELECT 'total_faturamento' AS kpi, '' AS chave, total_faturamento AS valor FROM g
      UNION ALL SELECT 'qtd_notas_fiscais', '', CAST(qtd_notas_fiscais AS DOUBLE) FROM g
      UNION ALL SELECT 'total_itens', '', CAST(total_itens AS DOUBLE) FROM g
      UNION ALL SELECT 'ticket_medio', '', ticket_medio FROM g
      UNION ALL SELECT 'top_produtos_valor', codigo, total FROM v
      UNION ALL SELECT 'top_produtos_qtd', codigo, total FROM q
      UNION ALL SELECT 'vendas_por_mes', mes, total FROM m""",
    "distinct_by_months": f"""WITH {CLEAN},
      seen AS (SELECT DISTINCT strftime(data_emissao, '%Y-%m') AS mes, id_venda, codigo_produto
        FROM clean WHERE data_emissao IS NOT NULL),
      ranges AS (SELECT DISTINCT
          strftime(CAST(mes || '-01' AS DATE) - to_months(antes), '%Y-%m') AS inicio, mes AS fim
        FROM seen CROSS JOIN (VALUES (0), (11)) AS t(antes))
      SELECT inicio, fim, count(DISTINCT id_venda) AS notas,
        count(DISTINCT codigo_produto) AS produtos
      FROM ranges JOIN seen ON mes BETWEEN inicio AND fim GROUP BY inicio, fim""",
    # sinks and audit
    "parquet_roundtrip": CLEAN_ROWS,
    "csv_roundtrip": CLEAN_ROWS.replace("* REPLACE (", """* REPLACE (
      CASE protocolo WHEN '1' THEN 'a' || chr(10) || 'b'
        WHEN '2' THEN 'a "b",' || chr(13) || chr(10)
        WHEN '3' THEN '' WHEN '4' THEN NULL ELSE unidade_medida END AS unidade_medida, """),
    "bi_csv_rows": f"""WITH {CLEAN}
      SELECT '{CSV_HEADER}' AS cabecalho, {CSV_LINE} AS linha FROM clean""",
    "bi_csv_roundtrip": f"""WITH {CLEAN}
      SELECT protocolo, CASE protocolo WHEN '1' THEN 'a' || chr(10) || 'b'
        WHEN '2' THEN 'a "b",' || chr(10) WHEN '3' THEN chr(1) WHEN '4' THEN ''
        ELSE unidade_medida END AS unidade_medida, quantidade FROM clean""",
    "json_rows": f"WITH {CLEAN} SELECT {JSON_LINE} AS value FROM clean",
    "report_lines": REPORT,
    "pipeline_run": f"""WITH {GRID},
      u AS (SELECT * FROM grid_items UNION ALL BY NAME SELECT * FROM flat_items),
      k AS (SELECT * EXCLUDE (arquivo_origem), min(arquivo_origem) AS arquivo_origem
            FROM u GROUP BY ALL)
      SELECT *, split_part(produto, ' - ', 1) AS codigo_produto,
        split_part(produto, ' - ', 2) AS descricao_produto,
        tipo_documento || numero_documento || coalesce(data_emissao, 'None') AS id_venda,
        tipo_documento || numero_documento || coalesce(data_emissao, 'None') || protocolo
          AS id_item_venda
      FROM k""",
    "stage_metrics": f"""WITH {STAGES}
      SELECT 1 AS ord, 'ingestao' AS etapa, o AS linhas, NULL AS removidas FROM n
      UNION ALL SELECT 2, 'padronizacao', o, NULL FROM n
      UNION ALL SELECT 3, 'consolidacao', f, o - f FROM n
      UNION ALL SELECT 4, 'analytics', NULL, NULL
      UNION ALL SELECT 5, 'parquet', NULL, NULL
      UNION ALL SELECT 6, 'csv', f, NULL FROM n""",
    "audit_summary": f"""WITH {STAGES}
      SELECT 6 AS n_etapas, 2 * o + 2 * f AS linhas_total, 0 AS n_erros, true AS sucesso,
        '✓ 6 etapas, ' || format('{{:,}}', CAST(2 * o + 2 * f AS BIGINT)) || ' linhas' AS resumo
      FROM n""",
    # scalar functions
    "excel_serial_dates": """
      SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS data, count(*) AS linhas
      FROM lineitem GROUP BY ALL""",
    "doc_type_prefix": """
      SELECT split_part(o_orderpriority, '-', 1) AS tipo, count(*) AS linhas
      FROM orders GROUP BY ALL""",
    "strip_accents": f"""
      SELECT doc_id, translate(text, '{ACCENTED}', '{PLAIN}') AS texto FROM documents""",
    "truncate_text": "SELECT doc_id, coalesce(substring(text, 1, 255), '') AS texto FROM documents",
    "br_number": """
      SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        CASE WHEN l_orderkey % 19 = 0 OR l_orderkey % 17 = 0 THEN 0.0
          WHEN l_orderkey % 13 = 0 THEN -l_extendedprice
          WHEN l_orderkey % 11 = 0 THEN l_quantity * 1000
          ELSE l_extendedprice END AS valor
      FROM lineitem""",
    "br_date_parts": """
      SELECT CASE WHEN ok THEN day(o_orderdate) ELSE -1 END AS dia,
        CASE WHEN ok THEN month(o_orderdate) ELSE -1 END AS mes,
        CASE WHEN ok THEN year(o_orderdate) % 100 ELSE -1 END AS aa,
        count(*) AS linhas
      FROM (SELECT o_orderdate, o_orderkey % 19 <> 0 AND o_orderkey % 17 <> 0
          AND (o_orderkey % 13 <> 0
               OR (day(o_orderdate) >= 10 AND month(o_orderdate) >= 10)) AS ok
        FROM orders)
      GROUP BY ALL""",
    # calendar rules
    "sunday_sales": f"""WITH {ITEMS}
      SELECT arquivo_origem, count(*) AS itens_domingo,
        round(sum(valor_total_venda), 2) AS valor_domingo
      FROM items WHERE dayofweek(data_emissao) = 0 GROUP BY ALL""",
    "period_overlaps": f"""WITH {ITEMS},
      p AS (SELECT arquivo_origem, min(data_emissao) AS inicio, max(data_emissao) AS fim
            FROM items WHERE data_emissao IS NOT NULL GROUP BY ALL)
      SELECT a.arquivo_origem, CAST(a.inicio AS VARCHAR) AS inicio, CAST(a.fim AS VARCHAR) AS fim,
        count(b.arquivo_origem) AS n_sobrepostos
      FROM p a LEFT JOIN p b ON a.arquivo_origem <> b.arquivo_origem
        AND a.inicio <= b.fim AND b.inicio <= a.fim
      GROUP BY ALL""",
    "overlapping_files": f"""WITH {ITEMS},
      p AS (SELECT arquivo_origem, min(data_emissao) AS inicio, max(data_emissao) AS fim
            FROM items WHERE data_emissao IS NOT NULL GROUP BY ALL),
      m AS (SELECT a.arquivo_origem AS arquivo_a, b.arquivo_origem AS arquivo_b,
              greatest(a.inicio, b.inicio) AS inicio, least(a.fim, b.fim) AS fim
            FROM p a JOIN p b ON a.arquivo_origem < b.arquivo_origem
              AND a.inicio <= b.fim AND b.inicio <= a.fim)
      SELECT arquivo_a, arquivo_b, CAST(inicio AS VARCHAR) AS inicio, CAST(fim AS VARCHAR) AS fim,
        date_diff('day', CAST(inicio AS DATE), CAST(fim AS DATE)) + 1 AS dias FROM m""",
    "replaced_months": f"""WITH {ITEMS},
      counted AS (SELECT {MONTH} AS mes, arquivo_origem, count(*) AS n FROM items
        WHERE data_emissao IS NOT NULL GROUP BY ALL),
      winners AS (SELECT mes, arquivo_origem FROM (SELECT *, row_number() OVER (
        PARTITION BY mes ORDER BY n DESC, arquivo_origem DESC) AS r FROM counted) WHERE r = 1)
      SELECT coalesce({MONTH}, 'NaT') AS mes, arquivo_origem, count(*) AS linhas,
        round(sum(valor_total_venda), 2) AS valor
      FROM items WHERE data_emissao IS NULL
        OR ({MONTH}, arquivo_origem) IN (SELECT (mes, arquivo_origem) FROM winners)
      GROUP BY ALL""",
    "supersede_partial": f"""WITH {ITEMS},
      counted AS (SELECT {MONTH} AS mes, arquivo_origem, count(*) AS n FROM items
        WHERE data_emissao IS NOT NULL GROUP BY ALL),
      winners AS (SELECT mes, arquivo_origem FROM (SELECT *, row_number() OVER (
        PARTITION BY mes ORDER BY n DESC, arquivo_origem DESC) AS r FROM counted) WHERE r = 1),
      kept AS (SELECT {ITEM_COLUMNS}, min(arquivo_origem) AS arquivo_origem
        FROM items WHERE data_emissao IS NULL
          OR ({MONTH}, arquivo_origem) IN (SELECT (mes, arquivo_origem) FROM winners)
        GROUP BY ALL)
      SELECT arquivo_origem, {MONTH} AS mes, count(*) AS linhas,
        round(sum(valor_total_venda), 2) AS valor
      FROM kept GROUP BY ALL""",
    "period_scope": f"""WITH {CLEAN}
      SELECT CASE WHEN year(data_emissao) >= 1998 THEN 'ATUAL' ELSE 'ANTIGO' END
          AS sistema_origem,
        count(*) AS linhas, round(sum(valor_total_venda), 2) AS valor
      FROM clean GROUP BY ALL""",
    "seasonality_index": f"""WITH {CLEAN},
      t AS (SELECT year(data_emissao) AS ano, month(data_emissao) AS mes,
              sum(valor_total_venda) AS total
            FROM clean WHERE data_emissao IS NOT NULL GROUP BY ALL)
      SELECT mes, round(sum(total) / count(*), 2) AS media_mensal,
        round(avg(total) / (SELECT avg(total) FROM t), 4) AS indice
      FROM t GROUP BY mes""",
    "reprocess_idempotent": CLEAN_ROWS,
}
