"""The same queries as plain SQL over the test tables, written independently of the engine."""

from __future__ import annotations

import zlib

from . import literal as Q

RESP = """resp AS (
  SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS ano, o_orderpriority AS cargo,
         o_orderstatus AS nivel, o_totalprice AS valor,
         CASE WHEN o_totalprice <= 100000 THEN 'ate 100.000'
              WHEN o_totalprice <= 200000 THEN 'de 100.001 a 200.000'
              WHEN o_totalprice <= 300000 THEN 'de 200.001 a 300.000'
              WHEN o_totalprice <= 400000 THEN 'de 300.001 a 400.000'
              ELSE 'Acima de 400.001' END AS faixa,
         c_mktsegment AS setor, n_name AS pais, r_name AS regiao
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
TIER = RESP + """, tiered AS (
  SELECT *, CASE WHEN faixa LIKE '%300.001%' OR faixa LIKE 'Acima%' THEN 1 ELSE 0 END AS top_tier FROM resp)"""
FLAGS = RESP + """, ticks AS (
  SELECT l_orderkey, CAST(max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS f_returned,
         CAST(max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS INTEGER) AS f_accepted,
         CAST(max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS INTEGER) AS f_open,
         CAST(max(CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END) AS INTEGER) AS f_discount,
         CAST(max(CASE WHEN l_quantity >= 45 THEN 1 ELSE 0 END) AS INTEGER) AS f_bulk
  FROM lineitem GROUP BY l_orderkey),
flags AS (SELECT resp.*, f_returned, f_accepted, f_open, f_discount, f_bulk
          FROM resp LEFT JOIN ticks ON id = l_orderkey)"""
LABELS = """wide AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
BUILT = FLAGS + """, built AS (
  SELECT id, ano, cargo AS cargo_atual, nivel, setor AS setor_d_atuacao, regiao AS regiao_onde_mora,
         faixa AS faixa_salarial, coalesce(f_returned, 0) AS item_devolvido, coalesce(f_accepted, 0) AS item_aceito,
         coalesce(f_open, 0) AS pedido_aberto, coalesce(f_discount, 0) AS desconto_100pct
  FROM flags)"""

# Years by the form of their headers and answers; the others have headers in pairs and whole numbers.
BOOLEAN_YEARS, DOUBLE_YEARS = "(1996, 1998, 2001)", "(1997, 1999)"

FLAG_NAMES = ["f_returned", "f_accepted", "f_open", "f_discount", "f_bulk"]
FLAG_LABELS = ["Devolvido", "Aceito", "Aberto", "Desconto alto", "Volume"]

def _union(branches):
    return " UNION ALL ".join(branches)


def _counts(relation, columns):
    """One row per column: position, name and non-null count."""
    return _union(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", count({c}) AS non_null FROM {relation}"
        for i, c in enumerate(columns)
    )


EVENT_NUMBER = """numbered AS (
  SELECT event_type, CASE WHEN event_type = 'error' THEN props ELSE regexp_extract(props, '([0-9]+)', 1) END AS k
  FROM events)"""


def _described(relation, columns):
    return _union(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 7) AS mean,
        round(stddev_samp({c}), 7) AS std, CAST(min({c}) AS DOUBLE) AS min,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 7) AS q25,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 7) AS q50,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 7) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {relation}"""
        for c in columns
    )


RESP_COLUMNS = ["id", "ano", "cargo", "nivel", "valor", "faixa", "setor", "pais", "regiao"]
WIDE_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
WIDE_TYPES = ["bigint", "string", "string", "string", "bigint", "int", "int"]

YEARS = range(1995, 2002)
FIRST_COLUMNS = [
    ("cargo_atual", "cargo"), ("nivel", "nivel"), ("setor_d_atuacao", "setor"), ("regiao_onde_mora", "regiao"),
    ("faixa_salarial", "faixa"),
]
# Cleaned names of each form of headers, and what they hold.
COLUMNS = {
    "pair": [
        ("id", "id"), *FIRST_COLUMNS, ("item_devolvido", "f_returned"), ("item_aceito", "f_accepted"),
        ("pedido_aberto", "f_open"), ("desconto_100pct", "f_discount"), ("compra_em_volume", "f_bulk"),
    ],
    "boolean": [
        ("token", "id"), *FIRST_COLUMNS, ("item_devolvido", "f_discount"), ("item_aceito", "f_accepted"),
        ("pedido_em_aberto", "f_open"), ("item_devolvido_1", "f_returned"), ("compra_em_volume", "f_bulk"),
    ],
    "double": [
        ("token", "id"), *FIRST_COLUMNS, ("item_devolvido", "f_returned"), ("item_aceito", "f_accepted"),
        ("pedido_em_aberto", "f_open"), ("desconto_100pct", "f_discount"),
    ],
}
KEYWORD_COLUMNS = {
    "pair": [
        ("faixa_salarial", "faixa", "string"), ("item_devolvido", "f_returned", "int"),
        ("item_aceito", "f_accepted", "int"), ("desconto_100pct", "f_discount", "int"),
    ],
    "boolean": [
        ("faixa_salarial", "faixa", "string"), ("item_devolvido", "f_discount", "boolean"),
        ("item_aceito", "f_accepted", "boolean"), ("item_devolvido_1", "f_returned", "boolean"),
    ],
    "double": [
        ("faixa_salarial", "faixa", "string"), ("item_devolvido", "f_returned", "double"),
        ("item_aceito", "f_accepted", "double"), ("desconto_100pct", "f_discount", "double"),
    ],
}


# Raw headers of each form, and what becomes of the column: step of its last rename, final name, status.
HEADERS = {
    "pair": [
        ("('P0', 'id')", 0, "id", "same"), ("('P1_a ', 'Cargo Atual')", 0, "cargo_atual", "same"),
        ("('P1_b ', 'Nível')", 0, "nivel", "same"), ("('P1_c', \"Setor d'atuação\")", 0, "setor_d_atuacao", "same"),
        ("('P2_a ', 'Região onde mora')", 0, "regiao_onde_mora", "same"),
        ("('P2_h ', 'Faixa Salarial')", 0, "faixa_salarial", "same"),
        ("('P3_a ', 'Item Devolvido?')", 0, "item_devolvido", "same"),
        ("('P3_b ', 'Item Aceito?')", 0, "item_aceito", "same"), ("('P3_c ', 'Pedido/Aberto')", 0, "pedido_aberto", "same"),
        ("('P3_d ', 'Desconto 100%')", 0, "desconto_100pct", "same"),
        ("('P3_e ', 'Compra em Volume')", 0, "compra_em_volume", "same"),
    ],
    "boolean": [
        ("0.a_token", 1, "id", "renamed"), ("1.b_Cargo Atual", 0, "cargo_atual", "same"), ("1.c.1_Nível", 0, "nivel", "same"),
        ("1.d_Setor d'atuação", 0, "setor_d_atuacao", "same"), ("2.a_Região onde mora", 0, "regiao_onde_mora", "same"),
        ("2.h_Faixa Salarial", 0, "faixa_salarial", "same"), ("3.a.1_Item Devolvido?", 2, "desconto_100pct", "renamed"),
        ("3.b.1_Item Aceito?", 0, "item_aceito", "same"), ("3.c.1_Pedido em aberto", 1, "pedido_aberto", "renamed"),
        ("4.a.1_Item Devolvido?", 2, "item_devolvido", "renamed"), ("4.b.1_Compra em Volume", 0, "compra_em_volume", "same"),
    ],
    "double": [
        ("0.a_token", 2, "id", "renamed"), ("1.b_Cargo Atual", 0, "cargo_atual", "same"), ("1.c.1 Nível", 0, "nivel", "same"),
        ("1.d_Setor d'atuação", 0, "setor_d_atuacao", "same"), ("2.a_Região onde mora", 0, "regiao_onde_mora", "same"),
        ("2.h_Faixa Salarial", 0, "faixa_salarial", "same"), ("3.a.1_Item Devolvido?", 0, "item_devolvido", "same"),
        ("3.b.1_Item Aceito?", 0, "item_aceito", "same"), ("3.c.1_Pedido em aberto", 1, "pedido_aberto", "renamed"),
        ("3.d.1_Desconto 100%", 0, "desconto_100pct", "same"),
    ],
}


def _lineage(year):
    rows = []
    for i, ((header, step, name, status), (clean, source)) in enumerate(zip(HEADERS[_style(year)], COLUMNS[_style(year)])):
        text = header.replace("'", "''")
        rows.append(f"""SELECT CAST({year} AS INTEGER) AS edition, CAST({i} AS INTEGER) AS position, '{text}' AS header,
            '{clean}' AS clean, CAST({step} AS INTEGER) AS step, '{name}' AS "column", '{status}' AS status,
            count({source}) AS non_null FROM flags WHERE ano = {year}""")
    return _union(rows)


def _style(year):
    return "boolean" if year in (1996, 1998, 2001) else "double" if year in (1997, 1999) else "pair"


def _schema_diff(year):
    def counted(when):
        return _union(f"SELECT '{n}' AS c, count({v}) AS n FROM flags WHERE ano = {when}" for n, v in COLUMNS[_style(when)])

    return f"""SELECT CAST({year} AS INTEGER) AS ano, coalesce(b.c, o.c) AS "column", b.n AS base_non_null,
        o.n AS other_non_null,
        CASE WHEN o.n IS NULL THEN 'missing' WHEN b.n IS NULL THEN 'new' ELSE 'matched' END AS status
        FROM ({counted(1995)}) b FULL JOIN ({counted(year)}) o ON b.c = o.c"""


FAULTY = """faulty AS (SELECT *, CASE
        WHEN o_orderstatus = 'F' AND o_orderkey % 97 = 0 THEN 'extra fields'
        WHEN o_orderstatus = 'F' AND o_orderkey % 89 = 1 THEN 'bad value'
        WHEN o_orderstatus = 'F' AND o_orderkey % 83 = 2 THEN 'missing fields'
        WHEN o_orderstatus <> 'F' AND o_orderkey % 79 = 3 THEN 'bad value' END AS reason,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 97 <> 0 AND o_orderkey % 89 = 1 THEN 'o_totalprice'
        WHEN o_orderstatus <> 'F' AND o_orderkey % 79 = 3 THEN 'o_orderkey' END AS field FROM orders)"""

ORACLE: dict[str, str] = {
    "count_by_edition": f"WITH {RESP} SELECT ano, count(*) AS total FROM resp GROUP BY ano",
    "count_by_edition_level": f"WITH {RESP} SELECT ano, nivel, count(*) AS total FROM resp GROUP BY ano, nivel",
    "share_within_group": f"""WITH {RESP} SELECT ano, cargo, count(*) AS total,
        ROUND(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY ano), 1) AS pct FROM resp GROUP BY ano, cargo""",
    "share_overall": f"""WITH {TIER} SELECT cargo, count(*) AS total,
        ROUND(100.0 * sum(top_tier) / count(*), 1) AS pct_top_tier,
        ROUND(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct_mercado
        FROM tiered WHERE cargo <> '4-NOT SPECIFIED' GROUP BY cargo""",
    "top_k": f"""WITH {RESP} SELECT pais, count(*) AS total FROM resp GROUP BY pais
        ORDER BY total DESC, pais LIMIT 10""",
    "tier_rate": f"""WITH {TIER} SELECT cargo, count(*) AS total,
        ROUND(100.0 * sum(top_tier) / count(*), 1) AS pct_top FROM tiered GROUP BY cargo""",
    "tier_rate_by_two": f"""WITH {TIER} SELECT ano, regiao, count(*) AS total,
        ROUND(100.0 * sum(top_tier) / count(*), 1) AS pct_top FROM tiered GROUP BY ano, regiao""",
    "tier_rate_in": f"""WITH {TIER} SELECT nivel, ROUND(100.0 * sum(top_tier) / count(*), 1) AS pct_top
        FROM tiered WHERE nivel IN ('F', 'O') GROUP BY nivel""",
    "conditional_share": f"""WITH {RESP} SELECT ano,
        ROUND(100.0 * sum(CASE WHEN nivel = 'F' THEN 1 ELSE 0 END) / count(*), 1) AS fechados,
        ROUND(100.0 * sum(CASE WHEN nivel = 'O' THEN 1 ELSE 0 END) / count(*), 1) AS abertos
        FROM resp GROUP BY ano""",
    "conditional_rate": f"""WITH {TIER} SELECT ano,
        ROUND(100.0 * count(*) FILTER (nivel = 'F' AND top_tier = 1)
              / NULLIF(count(*) FILTER (nivel = 'F'), 0), 1) AS fechados_top,
        ROUND(100.0 * count(*) FILTER (nivel = 'O' AND top_tier = 1)
              / NULLIF(count(*) FILTER (nivel = 'O'), 0), 1) AS abertos_top,
        ROUND(100.0 * count(*) FILTER (nivel = 'X' AND top_tier = 1)
              / NULLIF(count(*) FILTER (nivel = 'X'), 0), 1) AS sem_base
        FROM tiered GROUP BY ano""",
    "growth": f"""WITH {RESP}, t AS (SELECT count(*) FILTER (ano = 1995) AS total_1995,
        count(*) FILTER (ano = 2000) AS total_2000 FROM resp)
        SELECT total_1995, total_2000,
        ROUND(100.0 * (total_2000 - total_1995) / NULLIF(total_1995, 0), 1) AS variacao_pct FROM t""",
    "truthy_rate": f"""WITH {FLAGS}, spelled AS (SELECT ano,
        CASE ano WHEN 1995 THEN '1' WHEN 1996 THEN '1.0' WHEN 1997 THEN 'TRUE' ELSE 'Sim' END AS yes, f_returned, f_bulk
        FROM flags), texts AS (SELECT ano,
        CASE f_returned WHEN 1 THEN yes WHEN 0 THEN 'não' END AS r, CASE f_bulk WHEN 1 THEN yes WHEN 0 THEN 'não' END AS b
        FROM spelled)
        SELECT ano,
        ROUND(100.0 * sum(CASE WHEN lower(r) IN ('1','1.0','true','sim') THEN 1 ELSE 0 END) / count(*), 1) AS pct_returned,
        ROUND(100.0 * sum(CASE WHEN lower(b) IN ('1','1.0','true','sim') THEN 1 ELSE 0 END) / count(*), 1) AS pct_bulk
        FROM texts GROUP BY ano""",
    "value_counts": f"""WITH {LABELS} SELECT quality, count(*) AS total FROM wide
        WHERE quality IS NOT NULL GROUP BY quality""",
    "value_counts_nulls": f"WITH {LABELS} SELECT quality, count(*) AS total FROM wide GROUP BY quality",
    "grouped_value_counts": f"WITH {RESP} SELECT faixa, cargo, count(*) AS total FROM resp GROUP BY faixa, cargo",
    "distinct_values": f"WITH {LABELS} SELECT DISTINCT quality FROM wide",
    "flag_sum": f"""WITH {FLAGS} SELECT nivel, count(*) AS total, CAST(sum(f_bulk) AS BIGINT) AS em_volume
        FROM flags GROUP BY nivel""",
    "multi_flag_sum": f"WITH {FLAGS} SELECT ano, "
    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS n_{c}" for c in FLAG_NAMES) + " FROM flags GROUP BY ano",
    "multi_flag_pct": f"WITH {FLAGS} SELECT ano, "
    + ", ".join(f"ROUND(100.0 * sum({c}) / count(*), 1) AS pct_{c}" for c in FLAG_NAMES) + " FROM flags GROUP BY ano",
    "ranking_overall": f"WITH {FLAGS} " + _union(
        f"SELECT '{label}' AS option, CAST(sum(coalesce({c}, 0)) AS BIGINT) AS total FROM flags"
        for c, label in zip(FLAG_NAMES, FLAG_LABELS)),
    "ranking_by_edition": f"WITH {FLAGS} " + _union(
        f"SELECT ano, '{label}' AS option, CAST(sum(coalesce({c}, 0)) AS BIGINT) AS total FROM flags GROUP BY ano"
        for c, label in zip(FLAG_NAMES, FLAG_LABELS)),
    "totals_across_editions": f"""WITH {FLAGS}, sums AS (
        SELECT ano, coalesce(sum(f_returned), 0) AS r, coalesce(sum(f_discount), 0) AS d,
        coalesce(sum(f_accepted), 0) AS a, coalesce(sum(f_bulk), 0) AS b FROM flags GROUP BY ano)
        SELECT 'Devolvido' AS option,
        CAST(sum(CASE WHEN ano IN {BOOLEAN_YEARS} THEN greatest(r, d) ELSE r END) AS BIGINT) AS total FROM sums
        UNION ALL SELECT 'Aceito', CAST(sum(a) AS BIGINT) FROM sums
        UNION ALL SELECT 'Volume', CAST(sum(b) AS BIGINT) FROM sums WHERE ano NOT IN {DOUBLE_YEARS}
        UNION ALL SELECT 'Ausente', 0""",
    "unpivot_flags": f"WITH {FLAGS} " + _union(
        f"SELECT id, ano, '{label}' AS option FROM flags WHERE {c} = 1"
        for c, label in [("f_returned", "Devolvido"), ("f_discount", "Desconto alto"), ("f_bulk", "Volume")]),
    "current_vs_ideal": f"""WITH {RESP}, long AS (
        SELECT cargo AS v, 'Atual' AS situacao FROM resp WHERE cargo <> '4-NOT SPECIFIED'
        UNION ALL SELECT setor, 'Ideal' FROM resp)
        SELECT CASE v WHEN 'BUILDING' THEN 'Construção' WHEN '1-URGENT' THEN 'Urgente' WHEN '5-LOW' THEN 'Baixa'
        ELSE v END AS modelo, situacao, count(*) AS total FROM long GROUP BY v, situacao""",
    "tier_flag": f"WITH {TIER} SELECT id, top_tier FROM tiered",
    "recode_by_edition": f"""WITH {RESP} SELECT id,
        CASE WHEN ano = 2001 AND cargo IN ('4-NOT SPECIFIED', '5-LOW') THEN 'Gestor'
        WHEN ano = 1995 AND cargo = '4-NOT SPECIFIED' THEN 'Análise' ELSE cargo END AS cargo_ok FROM resp""",
    "classify_prefix": f"""WITH {RESP}, g AS (SELECT ano, CASE WHEN cargo LIKE '1-%' THEN 'Urgente'
        WHEN cargo LIKE '2-%' OR cargo LIKE '3-%' THEN 'Normal' ELSE 'Sem informação' END AS grupo FROM resp)
        SELECT ano, grupo, count(*) AS total,
        ROUND(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY ano), 1) AS pct FROM g GROUP BY ano, grupo""",
    "classify_contains": """SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' THEN 'Anel' ELSE 'Outro' END AS grupo
        FROM part""",
    "classify_two_flags": f"""WITH {FLAGS} SELECT id, CASE WHEN f_discount = 1 THEN 'Com desconto'
        WHEN f_bulk = 1 THEN 'Em volume' ELSE 'Outro cenário' END AS grupo FROM flags""",
    "classify_ordered": """SELECT p_partkey, CASE WHEN p_size = 7 THEN 'Sem resposta'
        WHEN p_name LIKE 'red%' THEN 'Vermelho' WHEN p_name LIKE 'small r%' THEN 'Pequeno r'
        WHEN p_name LIKE '%ring%' THEN 'Anel' WHEN p_name LIKE 'small%' THEN 'Pequeno'
        ELSE 'Sem resposta' END AS grupo FROM part""",
    "classify_keywords": f"""WITH {RESP} SELECT id, CASE WHEN faixa LIKE 'Acima%' THEN 'Topo'
        WHEN faixa = 'de 300.001 a 400.000' THEN 'Alta' WHEN faixa LIKE '%200.0%' THEN 'Média'
        ELSE 'Base' END AS grupo FROM resp""",
    "map_with_fallback": f"""WITH {RESP} SELECT id, CASE cargo WHEN '1-URGENT' THEN 'Urgente' WHEN '2-HIGH' THEN 'Alta'
        WHEN '3-MEDIUM' THEN 'Média' WHEN '5-LOW' THEN 'Baixa' ELSE cargo END AS rotulo FROM resp""",
    "map_no_fallback": f"""WITH {RESP} SELECT id, CASE cargo WHEN '1-URGENT' THEN 'Urgente' WHEN '2-HIGH' THEN 'Alta'
        WHEN '3-MEDIUM' THEN 'Média' WHEN '5-LOW' THEN 'Baixa' END AS rotulo FROM resp""",
    "map_long_table": """SELECT o_orderkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS cliente
        FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey""",
    "classify_rule_table": """WITH rules AS (
        SELECT p_partkey AS place, CASE WHEN p_partkey % 3 = 0 THEN 'starts' ELSE 'contains' END AS how,
        string_split(p_name, ' ')[1] || ' ' || substring(string_split(p_name, ' ')[2], 1, 4) AS fragment,
        'peça ' || p_partkey AS label FROM part
        UNION ALL SELECT 10000000 + item_id, 'contains', substring(text, 1, 40), 'passagem ' || item_id FROM benchmark
        UNION ALL SELECT 20000000 + doc_id, 'starts', substring(text, 1, 12), 'início ' || doc_id FROM documents),
        hits AS (SELECT doc_id, min_by(label, place) AS label FROM documents, rules
        WHERE CASE how WHEN 'starts' THEN starts_with(lower(text), lower(fragment))
        ELSE contains(lower(text), lower(fragment)) END GROUP BY doc_id)
        SELECT d.doc_id, coalesce(label, 'outro') AS grupo FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id""",
    "dedup_first_in_file": """SELECT o_orderstatus, o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "dedup_by_key": """SELECT doc_id, text, lang, source, n_chars FROM (
        SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
    "bool_to_flag": f"WITH {FLAGS} SELECT id, f_returned, CAST(f_accepted AS VARCHAR) AS f_accepted FROM flags",
    "binary_columns": f"""WITH {LABELS} SELECT 'doc_id' AS "column", bool_and(doc_id IN (0, 1)) AS is_binary FROM wide
        UNION ALL SELECT 'lang', false UNION ALL SELECT 'n_chars', bool_and(n_chars IN (0, 1)) FROM wide
        UNION ALL SELECT 'quality', bool_and(quality IN (0, 1)) FROM wide
        UNION ALL SELECT 'toxic', bool_and(toxic IN (0, 1)) FROM wide
        UNION ALL SELECT 'half', bool_and(quality * 0.5 IN (0, 1)) FROM wide
        UNION ALL SELECT 'texto', bool_and(toxic IN (0, 1)) FROM wide""",
    "fill_binary": "SELECT user_id, CAST(ts AS DATE) AS day, " + ", ".join(
        f"CAST(max(CASE WHEN event_type = '{kind}' THEN 1 ELSE 0 END) AS INTEGER) AS {kind}"
        for kind in ("view", "click", "purchase", "signup", "error")) + " FROM events GROUP BY 1, 2",
    "fill_text": f"""WITH {LABELS} SELECT doc_id,
        CASE WHEN quality IS NOT NULL AND lang IS NOT NULL THEN lang ELSE 'Nao_informado' END AS lingua, quality
        FROM wide""",
    "try_cast_sum": f"""WITH {EVENT_NUMBER} SELECT event_type, count(*) AS total,
        CAST(sum(TRY_CAST(k AS INTEGER)) AS BIGINT) AS soma FROM numbered GROUP BY event_type""",
    "coerce_numeric": f"""WITH {EVENT_NUMBER} SELECT event_type, sum(coalesce(TRY_CAST(k AS DOUBLE), 0)) AS soma
        FROM numbered GROUP BY event_type""",
    "normalise_text": """SELECT doc_id,
        trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', '_', 'g'), '_') AS texto FROM documents""",
    "clean_headers": """WITH words AS (SELECT p_partkey, p_size,
        replace(p_name, ' ', '_') || '_' || lower(p_type) AS w FROM part)
        SELECT p_partkey, CASE WHEN p_size < 15 THEN 'opcao_' || w WHEN p_size < 30 THEN 'peca_d_agua_100pct_' || w
        WHEN p_size < 40 THEN 'remuneracao_salario_' || w ELSE w || '_e_so_isso' END AS nome FROM words""",
    "twin_suffix": """SELECT p_partkey, CASE WHEN rn = 1 THEN p_name ELSE p_name || '_' || (rn - 1) END AS nome FROM (
        SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part)""",
    "harmonise_editions": f"""WITH {FLAGS} SELECT id, ano, cargo AS cargo_atual, nivel, setor AS setor_d_atuacao,
        regiao AS regiao_onde_mora, faixa AS faixa_salarial, CAST(f_returned AS DOUBLE) AS item_devolvido,
        CAST(f_accepted AS DOUBLE) AS item_aceito, CAST(f_open AS DOUBLE) AS pedido_aberto,
        CAST(f_discount AS DOUBLE) AS desconto_100pct FROM flags""",
    "swap_correction": f"""WITH {FLAGS} SELECT id, ano, f_discount AS desconto_100pct, f_returned AS item_devolvido
        FROM flags""",
    "curated_select": f"""WITH {FLAGS} SELECT id, ano, faixa AS faixa_salarial,
        CAST(f_discount AS DOUBLE) AS desconto_100pct,
        CASE WHEN ano NOT IN {DOUBLE_YEARS} THEN f_bulk END AS compra_em_volume FROM flags""",
    "unify_common": f"WITH {BUILT} SELECT * FROM built",
    "unify_outer": f"""WITH {FLAGS} SELECT id, ano, f_returned AS item_devolvido,
        CASE WHEN ano NOT IN {DOUBLE_YEARS} THEN f_bulk END AS compra_em_volume FROM flags""",
    "unify_as_string": f"""WITH {BUILT} SELECT CAST(id AS VARCHAR) AS id, CAST(ano AS VARCHAR) AS ano, cargo_atual, nivel,
        setor_d_atuacao, regiao_onde_mora, faixa_salarial, CAST(item_devolvido AS VARCHAR) AS item_devolvido,
        CAST(item_aceito AS VARCHAR) AS item_aceito, CAST(pedido_aberto AS VARCHAR) AS pedido_aberto,
        CAST(desconto_100pct AS VARCHAR) AS desconto_100pct FROM built""",
    "dup_columns_last": f"WITH {FLAGS} SELECT id, f_discount AS marca FROM flags",
    "dup_columns_first": f"WITH {FLAGS} SELECT id, f_returned AS marca FROM flags",
    "dup_columns_max_sum": f"""WITH {FLAGS} SELECT ano,
        CAST(greatest(sum(f_returned), sum(f_discount)) AS BIGINT) AS contagem FROM flags GROUP BY ano""",
    "schema_diff": f"WITH {FLAGS} " + _union(_schema_diff(year) for year in YEARS[1:]),
    "keyword_columns": f"WITH {FLAGS} " + _union(
        f"SELECT CAST({year} AS INTEGER) AS ano, '{n}' AS column, '{t}' AS dtype, count({v}) AS non_null FROM flags WHERE ano = {year}"
        for year in YEARS for n, v, t in KEYWORD_COLUMNS[_style(year)]),
    "column_lineage": f"WITH {FLAGS} " + _union(_lineage(year) for year in YEARS),
    "profile_shape": f"WITH {LABELS} SELECT count(*) AS n_rows, CAST(7 AS BIGINT) AS n_columns FROM wide",
    "profile_nonnull": f"WITH {LABELS} " + _union(
        f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null FROM wide"""
        for i, (c, t) in enumerate(zip(WIDE_COLUMNS, WIDE_TYPES))),
    "profile_nulls": f"WITH {LABELS} " + _union(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls FROM wide""" for c in WIDE_COLUMNS),
    "null_total": f"WITH {LABELS} SELECT CAST(" + " + ".join(
        f"count(*) - count({c})" for c in WIDE_COLUMNS) + " AS BIGINT) AS nulls FROM wide",
    "profile_describe": f"WITH {LABELS} " + _described("wide", ["doc_id", "n_chars", "quality", "toxic"]),
    "describe_many_values": _described("lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
    "minmax_sweep": f"WITH {LABELS} " + _union(
        f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM wide"""
        for c in ["doc_id", "n_chars", "quality", "toxic"]),
    "duplicate_rows": """SELECT doc_id, lang, n_chars FROM (
        SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS rn FROM documents) WHERE rn > 1""",
    "duplicate_groups": """SELECT text, lang, count(*) - 1 AS repeats FROM documents GROUP BY text, lang
        HAVING count(*) > 1""",
    "duplicate_count": """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents))
        AS duplicate_rows FROM documents""",
    "key_quality": """SELECT 'labels_wide' AS base, count(*) AS n_rows, count(DISTINCT d.doc_id) AS distinct_keys,
        count(*) - count(DISTINCT d.doc_id) AS duplicate_keys, count(*) - count(d.doc_id) AS null_keys
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey), count(*) - count(DISTINCT l_orderkey),
        count(*) - count(l_orderkey) FROM lineitem""",
    "show_columns": f"WITH {RESP} " + _counts("resp", RESP_COLUMNS),
    "preview": f"WITH {RESP} SELECT * FROM resp ORDER BY id LIMIT 5",
    "csv_roundtrip": "SELECT doc_id, lang, text FROM documents",
    "csv_deviating_files": f"""WITH {FAULTY} SELECT
        CASE WHEN reason = 'bad value' AND field = 'o_orderkey' THEN NULL ELSE o_orderkey END AS o_orderkey,
        CASE WHEN reason = 'bad value' AND field = 'o_totalprice' THEN NULL ELSE o_totalprice END AS o_totalprice,
        CASE WHEN reason = 'missing fields' THEN NULL WHEN o_orderkey % 5 = 0 THEN o_orderpriority || ',' || chr(10) || '"x" '
        ELSE o_orderpriority END AS nota FROM faulty""",
    "csv_rejected_rows": f"""WITH {FAULTY} SELECT reason, field, count(*) AS n_records FROM faulty
        WHERE reason IS NOT NULL GROUP BY reason, field""",
    "bucketed_dedup": """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_quantity) AS rn FROM lineitem) WHERE rn = 1""",
    "replaced_table": f"WITH {RESP} SELECT * REPLACE (valor * 2 AS valor) FROM resp",
    "parquet_partition_roundtrip": f"WITH {RESP} SELECT * FROM resp",
    "silver_from_csv": f"WITH {BUILT} SELECT * FROM built",
}


ORACLE["dedup_rare_repeats"] = ORACLE["dedup_by_key"]
ORACLE["duplicate_groups_wide"] = ORACLE["duplicate_groups"]

# The questionnaire-shaped view and its indicators

def _answer(name):
    source, answers = Q.ANSWERS[name]
    cases = " ".join(f"WHEN '{value}' THEN '{text}'" for value, text in answers.items())
    return f'CASE {source} {cases} END AS "{name}"'


def _tick(column):
    """Each option is ticked by a rule of its own, made from the column's name."""
    code = zlib.crc32(column.encode())
    return f'CAST((parts * {code % 9972 + 1}) % 9973 < {1000 + code % 6700} AS INTEGER) AS "{column}"'


SURVEY = f"""bought AS (SELECT l_orderkey, CAST(sum(l_partkey) AS BIGINT) AS parts FROM lineitem GROUP BY l_orderkey),
survey AS (SELECT o_orderkey AS id, CAST(year(o_orderdate) + {Q.YEAR_SHIFT} AS INTEGER) AS ano,
  n_name AS {Q.SECTOR}, r_name AS {Q.REGION}, 'n' || (n_nationkey % 7) AS {Q.RACE},
  CASE WHEN c_acctbal < 0 THEN 'Outro' WHEN c_acctbal < 4000 THEN 'Feminino' ELSE 'Masculino' END AS {Q.GENDER},
  CASE {" ".join(f"WHEN o_totalprice <= {limit} THEN '{text}'" for limit, text in Q.PRICE_BANDS)}
       ELSE '{Q.TOP_BAND}' END AS {Q.BAND},
  {", ".join(_answer(name) for name in Q.ANSWERS)},
  {", ".join(_tick(c) for c in Q.TICKS)}
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey LEFT JOIN bought ON o_orderkey = l_orderkey),
vw AS (SELECT *,
  CASE WHEN ano = 2025 AND atuacao IN ('0', '1', 'Nao_informado') THEN 'Gestor'
       WHEN ano = 2023 AND atuacao = 'Nao_informado' THEN 'Análise de Dados' ELSE atuacao END AS atuacao_ok,
  CASE WHEN faixa_salarial LIKE '%12.001%' OR faixa_salarial LIKE '%20.001%' OR faixa_salarial LIKE 'Acima%'
       THEN 1 ELSE 0 END AS top_tier FROM survey)"""


def _gold_count(*by):
    keys = ", ".join(by)
    return f"WITH {SURVEY} SELECT {keys}, count(*) AS total FROM vw GROUP BY {keys}"


def _gold_share(category, source="vw"):
    return f"""WITH {SURVEY} SELECT ano, {category}, count(*) AS total,
        ROUND(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY ano), 1) AS pct FROM {source} GROUP BY ano, {category}"""


def _gold_tier(*by):
    keys = ", ".join(by)
    return f"""WITH {SURVEY} SELECT {keys}, count(*) AS total, ROUND(100.0 * sum(top_tier) / count(*), 1) AS pct_top
        FROM vw GROUP BY {keys}"""


def _gold_sums(flags):
    sums = ", ".join(f'CAST(sum("{c}") AS BIGINT) AS {name}' for name, c in flags.items())
    return f"WITH {SURVEY} SELECT ano, {sums} FROM vw GROUP BY ano"


def _gold_percents(flags):
    parts = ", ".join(f'ROUND(100.0 * sum("{c}") / count(*), 1) AS {name}' for name, c in flags.items())
    return f"WITH {SURVEY} SELECT ano, {parts} FROM vw GROUP BY ano"


def _gold_ranking(flags, label="opcao", by_year=False):
    head, tail = ("ano, ", " GROUP BY ano") if by_year else ("", "")
    return f"WITH {SURVEY} " + _union(
        f"""SELECT {head}'{text}' AS {label}, CAST(sum(coalesce("{c}", 0)) AS BIGINT) AS total FROM vw{tail}"""
        for text, c in flags.items()
    )


def _gender_rate(gender):
    return f"""ROUND(100.0 * sum(CASE WHEN genero = '{gender}' AND top_tier = 1 THEN 1 ELSE 0 END)
        / NULLIF(sum(CASE WHEN genero = '{gender}' THEN 1 ELSE 0 END), 0), 1)"""


def _ticked_percent(column):
    return f"""ROUND(100.0 * sum(CASE WHEN lower({column}) IN ('1', '1.0', 'true', 'sim') THEN 1 ELSE 0 END)
        / count(*), 1)"""


# Editions that lack the last column asked for.
LACKING = "(2020, 2023)"


def _has(column, lacking):
    return f"ano NOT IN {LACKING}" if column == lacking else "true"


def _extract_totals(options, label):
    """Sums over all editions, two of which lack the last column."""
    lacking = list(options.values())[-1]
    return f"WITH {SURVEY} " + _union(
        f"""SELECT '{text}' AS {label}, CAST(sum(coalesce("{c}", 0)) AS BIGINT) AS contagem FROM vw
        WHERE {_has(c, lacking)}"""
        for text, c in options.items()
    )


def _extract_long(options, name):
    lacking = list(options)[-1]
    return f"WITH {SURVEY} " + _union(
        f"""SELECT id, ano, '{label}' AS {name} FROM vw WHERE "{c}" = 1 AND {_has(c, lacking)}"""
        for c, label in options.items()
    )


SHORT_MODELS = " ".join(f"WHEN '{text}' THEN '{short}'" for text, short in Q.MODEL_LABELS.items())

GOLD = {
    "editions": _gold_count("ano"),
    "roles_share": _gold_share("atuacao"),
    "roles_comparable_share": _gold_share("atuacao_ok"),
    "seniority": _gold_count("ano", "nivel"),
    "top_sectors": f"WITH {SURVEY} SELECT setor, count(*) AS total FROM vw GROUP BY setor ORDER BY total DESC, setor LIMIT 10",
    "tier_by_role": _gold_tier("atuacao"),
    "tier_by_seniority": _gold_tier("nivel"),
    "tier_by_education": f"""WITH {SURVEY} SELECT nivel_de_ensino, count(*) AS total,
        ROUND(100.0 * sum(top_tier) / count(*), 1) AS pct_top_tier,
        ROUND(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct_mercado
        FROM vw WHERE nivel_de_ensino <> 'Nao_informado' GROUP BY nivel_de_ensino""",
    "gender_shares": f"""WITH {SURVEY} SELECT ano,
        ROUND(100.0 * sum(CASE WHEN genero = 'Feminino' THEN 1 ELSE 0 END) / count(*), 1) AS mulheres,
        ROUND(100.0 * sum(CASE WHEN genero = 'Masculino' THEN 1 ELSE 0 END) / count(*), 1) AS homens
        FROM vw GROUP BY ano""",
    "gender_share_long": _gold_share("genero"),
    "gender_tier_gap": f"""WITH {SURVEY} SELECT ano, {_gender_rate("Feminino")} AS mulheres_top,
        {_gender_rate("Masculino")} AS homens_top FROM vw GROUP BY ano""",
    "gender_tier_rate": f"""WITH {SURVEY} SELECT genero, ROUND(100.0 * sum(top_tier) / count(*), 1) AS pct_top
        FROM vw WHERE genero IN ('Masculino', 'Feminino') GROUP BY genero""",
    "prejudice_by_gender": f"""WITH {SURVEY} SELECT genero, CAST(sum({Q.PREJUDICE_GENDER}) AS BIGINT) AS preconceito_genero
        FROM vw GROUP BY genero""",
    "prejudice_by_race": f"""WITH {SURVEY} SELECT cor_raca_etnia, count(*) AS total,
        CAST(sum({Q.PREJUDICE_RACE}) AS BIGINT) AS preconceito_raca FROM vw GROUP BY cor_raca_etnia""",
    "languages": _gold_sums(Q.LANGUAGES),
    "languages_pct": _gold_percents(Q.LANGUAGES_MORE),
    "databases": _gold_sums(Q.DATABASES),
    "databases_ranking": _gold_ranking(Q.DATABASES_RANKED),
    "clouds": _gold_sums(Q.CLOUDS),
    "clouds_pct": _gold_percents(Q.CLOUDS_MAIN),
    "preferred_cloud": _gold_count("ano", "cloud_preferida"),
    "bi_tools": _gold_sums(Q.BI_TOOLS),
    "bi_tools_ranking": _gold_ranking(Q.BI_TOOLS_RANKED),
    "daily_bi_tool": _gold_count("ano", Q.BI_DAILY),
    "ai_use_groups": f"""WITH {SURVEY}, base AS (SELECT ano,
        CASE WHEN {Q.AI_AT_WORK} LIKE 'Utilizo%' THEN 'Usa IA no trabalho'
        WHEN {Q.AI_AT_WORK} LIKE 'Não%' THEN 'Não usa IA' ELSE 'Sem informação' END AS uso_ia_grupo FROM vw)
        SELECT ano, uso_ia_grupo, count(*) AS total,
        ROUND(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY ano), 1) AS pct FROM base GROUP BY ano, uso_ia_grupo""",
    "ai_payer_pct": _gold_percents(Q.AI_PAYER),
    "ai_in_company_pct": _gold_percents(Q.AI_IN_COMPANY),
    "ai_priority_pct": _gold_percents(Q.AI_PRIORITIES),
    "ai_barriers": _gold_sums(Q.AI_BARRIERS),
    "ai_barriers_ranking": _gold_ranking(Q.AI_BARRIERS_RANKED),
    "edition_growth": f"""WITH {SURVEY}, t AS (SELECT count(*) FILTER (ano = 2023) AS total_2023,
        count(*) FILTER (ano = 2025) AS total_2025 FROM vw) SELECT total_2023, total_2025,
        ROUND(100.0 * (total_2025 - total_2023) / NULLIF(total_2023, 0), 1) AS variacao_pct FROM t""",
    "tier_by_model": _gold_tier("ano", Q.MODEL_NOW),
    "tier_by_model_overall": _gold_tier(Q.MODEL_NOW),
    "tier_by_region": _gold_tier("ano", "regiao_onde_mora"),
    "tier_by_region_overall": _gold_tier("regiao_onde_mora"),
    "current_model": _gold_count("ano", Q.MODEL_NOW),
    "current_model_overall": _gold_count(Q.MODEL_NOW),
    "ideal_model": _gold_count("ano", Q.MODEL_IDEAL),
    "ideal_model_overall": _gold_count(Q.MODEL_IDEAL),
    "challenges": _gold_ranking(Q.CHALLENGES, "desafio", by_year=True),
    "challenges_ranking": _gold_ranking(Q.CHALLENGES, "desafio"),
    "values": _gold_ranking(Q.VALUES, "valor", by_year=True),
    "values_ranking": _gold_ranking(Q.VALUES, "valor"),
    "data_maturity": f"""WITH {SURVEY} SELECT ano, {_ticked_percent(Q.DATA_LAKE)} AS pct_lake,
        {_ticked_percent(Q.DATA_WAREHOUSE)} AS pct_dw FROM vw GROUP BY ano""",
}
ORACLE.update({f"gold_{name}": sql for name, sql in GOLD.items()})

ORACLE.update({
    "gold_view_rows": f"WITH {SURVEY} SELECT id, ano, atuacao, faixa_salarial, atuacao_ok, top_tier FROM vw",
    "extract_current_vs_ideal": f"""WITH {SURVEY}, long AS (
        SELECT {Q.MODEL_NOW} AS m, 'Atual' AS situacao FROM vw
        UNION ALL SELECT {Q.MODEL_IDEAL}, 'Ideal' FROM vw)
        SELECT CASE m {SHORT_MODELS} ELSE m END AS modelo, situacao, count(*) AS total
        FROM long WHERE m IS NOT NULL GROUP BY 1, 2""",
    "extract_challenge_totals": _extract_totals(Q.CHALLENGES, "desafio"),
    "extract_value_totals": _extract_totals(Q.VALUES, "valor"),
    "extract_maturity": f"""WITH {SURVEY} SELECT ano,
        ROUND(100.0 * sum(CASE WHEN {Q.DATA_LAKE} IN ('1', '1.0', 'TRUE') THEN 1 ELSE 0 END) / count(*), 1) AS pct_lake,
        ROUND(100.0 * sum(CASE WHEN {Q.DATA_WAREHOUSE} = '1' THEN 1 ELSE 0 END) / count(*), 1) AS pct_dw
        FROM vw GROUP BY ano""",
    "extract_ai_barriers": _extract_long(Q.BARRIER_OPTIONS, "barreira"),
    "extract_ai_barriers_more": _extract_long(Q.BARRIER_OPTIONS_MORE, "barreira"),
    "extract_ai_uses": _extract_long(Q.AI_USE_OPTIONS, "forma_uso"),
    "extract_ai_answers": f"""WITH {SURVEY} SELECT id, ano,
        CASE WHEN {Q.AI_AT_WORK} LIKE '%Utilizo%' THEN 'Usa IA no trabalho' ELSE 'Não usa / não informou' END AS uso_ia_grupo,
        CASE WHEN {Q.AI_PRIORITY} = 1 THEN 'IA É prioridade na empresa'
             WHEN {Q.AI_NO_PRIORITY} = 1 THEN 'IA NÃO é prioridade' ELSE 'Outro cenário' END AS prioridade_grupo,
        CASE WHEN ano IN {LACKING} THEN NULL WHEN {Q.AI_RESULTS} LIKE 'Sim%' THEN 'Sim, bons resultados'
             WHEN {Q.AI_RESULTS} LIKE 'Em partes%' THEN 'Em partes / piloto'
             WHEN {Q.AI_RESULTS} LIKE '%ainda não%' THEN 'Ainda não começou'
             WHEN {Q.AI_RESULTS} LIKE 'Não%' THEN 'Não, sem resultados' ELSE 'Sem resposta' END AS resultado_grupo,
        {Q.AI_AT_WORK}, {Q.AI_PRIORITY}, {Q.AI_NO_PRIORITY}, {Q.FREE_AI},
        CASE WHEN ano NOT IN {LACKING} THEN {Q.AI_RESULTS} END AS {Q.AI_RESULTS} FROM vw""",
    "extract_short_model": f"""WITH {SURVEY} SELECT id, ano, {Q.MODEL_NOW}, atuacao,
        CASE {Q.MODEL_NOW} {SHORT_MODELS} ELSE 'Não informado' END AS forma_trabalho_curta FROM vw""",
})
