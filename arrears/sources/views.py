"""Domain views over the order and event tables that stand in for the municipality's own tables.

Each view is plain SQL; ``{orders}`` and the like name a base table, other views are named directly.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWED_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
BASE_TABLES = [
    *VIEWED_TABLES,
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

TIME_KEY = "extract(year FROM {0})*10000 + extract(month FROM {0})*100 + extract(day FROM {0})"

VIEWS: dict[str, str] = {
    # Bill line: certificate line with billed and paid money.
    "v_item": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_linestatus, l.l_returnflag, l.l_shipdate,
  l.l_quantity, l.l_tax, o.o_custkey, o.o_orderdate, o.o_orderpriority,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS vlr_total,
  CAST(CASE l.l_returnflag WHEN 'R' THEN l.l_extendedprice
    WHEN 'A' THEN floor(l.l_extendedprice*l.l_discount*5) ELSE 0 END AS DECIMAL(18,2)) AS vlr_pago
FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey""",
    # Certificates by debt type, taxpayer and open/closed partition.
    "v_divida": """
SELECT l_orderkey AS cda, CASE WHEN l_orderkey % 3 = 0 THEN 'mercantil' ELSE 'imovel' END AS tipo_divida,
  o_custkey AS id_pessoa, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS da_aberto,
  sum(vlr_total) AS valor_tot, sum(vlr_pago) AS valor_pago, max(l_linenumber)-1 AS quantidade_reparcelamento,
  max(CASE WHEN o_custkey % 5 <> 0 THEN 'ATIVO' ELSE 'INAPTO' END) AS situacao,
  max(CASE WHEN o_custkey % 4 = 0 THEN 0 ELSE 1 END) AS edificacao,
  max(CASE WHEN o_custkey % 10 = 0 THEN 0 ELSE 1 END) AS cpf_cnpj_existe,
  max(CASE WHEN o_custkey % 7 = 0 THEN 0 ELSE 1 END) AS endereco_existe,
  max(2002 - extract(year FROM o_orderdate)) AS idade_divida,
  max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS protesto,
  max(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS ajuizamento
FROM v_item GROUP BY 1, 2, 3, 4""",
    # Invoices per taxpayer.
    "v_notas": """
SELECT user_id AS id_pessoa, count(*) AS qtd_notas_2anos FROM {events} GROUP BY user_id""",
    # Property bills.
    "v_dam": """
SELECT i.l_orderkey*10 + i.l_linenumber AS dam, i.l_partkey AS id_imovel,
  CASE WHEN i.o_custkey % 17 = 0 THEN NULL ELSE i.o_custkey END AS id_contribuinte,
  extract(year FROM i.o_orderdate) AS ano_fato_gerador, i.vlr_total AS vlr_total_dam, i.vlr_pago,
  i.vlr_total - i.vlr_pago AS vlr_aberto,
  CASE p.p_type WHEN 'ECONOMY' THEN 'APARTAMENTO' WHEN 'STANDARD' THEN 'CASA' WHEN 'PROMO' THEN 'LOJA'
    WHEN 'SMALL' THEN 'SALA' WHEN 'MEDIUM' THEN 'GALPAO' ELSE NULL END AS tipo_propriedade,
  CASE WHEN p.p_partkey % 9 = 0 THEN 'T' ELSE 'P' END AS natureza_imovel,
  p.p_size*10 AS area_construida, p.p_size*2 AS idade_imovel, p.p_size AS qtd_pavimentos,
  concat(n.n_name, ' ') AS bairro, r.r_name AS regiao, n.n_nationkey % 6 AS rpa,
  CASE WHEN i.o_custkey % 8 = 0 THEN 'PJ' ELSE 'PF' END AS tipo_contribuinte,
  CASE WHEN i.l_returnflag = 'R' THEN i.o_orderdate ELSE NULL END AS data_ultimo_pagamento,
  CASE WHEN i.l_partkey % 5 = 0 THEN NULL ELSE p.p_brand END AS atualizacao_cadastro
FROM v_item i JOIN {part} p ON p.p_partkey = i.l_partkey JOIN {customer} c ON c.c_custkey = i.o_custkey
  JOIN {nation} n ON n.n_nationkey = c.c_nationkey JOIN {region} r ON r.r_regionkey = n.n_regionkey""",
    # Taxpayer history by year.
    "v_hist": """
SELECT extract(year FROM o_orderdate) AS ano, o_custkey AS id_contribuinte, sum(vlr_total) AS hist_valor_total,
  sum(vlr_pago) AS hist_valor_pago, count(DISTINCT l_partkey) AS num_imoveis,
  sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS pgt_cota_unica,
  sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS reco_inscricao,
  sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS reco_debito
FROM v_item GROUP BY 1, 2""",
    # Debt-register facts and dimensions of the source database.
    "v_fato_imovel": f"""
SELECT l_orderkey AS termo_da_unico, l_linestatus AS serie_da_cda, o_custkey AS chave_dim_imovel,
  CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN CASE WHEN l_linenumber % 2 = 0 THEN 103 ELSE 105 END
    ELSE 1 END AS chave_dim_situacao_processo,
  l_partkey % 20 AS chave_dim_tributo, vlr_total AS valor_total,
  {TIME_KEY.format('o_orderdate')} AS chave_tempo_inscricao,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'S' ELSE 'N' END AS protestada,
  CASE WHEN o_orderpriority = '2-HIGH' THEN {TIME_KEY.format('l_shipdate')} ELSE NULL END AS chave_tempo_ajuizamento
FROM v_item WHERE l_orderkey % 3 <> 0""",
    "v_fato_mercantil": f"""
SELECT l_orderkey AS termo_da_unico, l_linestatus AS serie_da_cda, o_custkey AS chave_dim_mercantil,
  CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN CASE WHEN l_linenumber % 2 = 0 THEN 103 ELSE 105 END
    ELSE 1 END AS chave_dim_situacao_processo,
  l_partkey % 20 AS chave_dim_tributo, vlr_total AS valor_total,
  {TIME_KEY.format('o_orderdate')} AS chave_tempo_inscricao,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'S' ELSE 'N' END AS protestada,
  CASE WHEN o_orderpriority = '2-HIGH' THEN {TIME_KEY.format('l_shipdate')} ELSE NULL END AS chave_tempo_ajuizamento
FROM v_item WHERE l_orderkey % 3 = 0""",
    "v_dim_imovel": """
SELECT c_custkey AS chave_dim_imovel, c_custkey + 1000000 AS seq_imovel_unico,
  CASE WHEN c_custkey % 5 <> 0 THEN 'ATIVO' ELSE 'INAPTO' END AS situacao_imovel,
  CASE WHEN c_custkey % 4 = 0 THEN 'T' ELSE 'P' END AS natureza_imovel,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS cpf_unico,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS tipo_propriedade_resp
FROM {customer} WHERE c_custkey % 13 <> 0""",
    "v_dim_mercantil": """
SELECT c_custkey AS chave_dim_merct, c_custkey + 2000000 AS insc_merct_unico,
  CASE WHEN c_custkey % 5 <> 0 THEN 'ATIVO' ELSE 'INAPTO' END AS a04_situacao_mercantil,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS cpf_unico
FROM {customer} WHERE c_custkey % 13 <> 0""",
    "v_dim_tempo": f"""
SELECT DISTINCT {TIME_KEY.format('o_orderdate')} AS chave_tempo, CAST(o_orderdate AS DATE) AS data FROM {{orders}}""",
    "v_debito_adm": """
SELECT CASE WHEN l_orderkey % 3 <> 0 THEN o_custkey + 1000000 END AS seq_imovel_unico,
  CASE WHEN l_orderkey % 3 = 0 THEN o_custkey + 2000000 END AS inscr_mercantil_unico,
  l_shipdate AS dt_vencimento, o_orderdate AS dt_fat_gerador, vlr_total AS vlr_lan_principal,
  CAST(floor(l_tax*1000) AS DECIMAL(18,2)) AS vlr_lan_correcao, CAST(l_quantity AS DECIMAL(18,2)) AS vlr_lan_juros,
  CAST(l_linenumber AS DECIMAL(18,2)) AS vlr_lan_multa, vlr_pago AS vlr_arr_principal,
  CAST(floor(l_tax*500) AS DECIMAL(18,2)) AS vlr_arr_correcao,
  CAST(floor(l_quantity/2) AS DECIMAL(18,2)) AS vlr_arr_juros, CAST(1 AS DECIMAL(18,2)) AS vlr_arr_multa,
  CAST(l_linenumber*2 AS DECIMAL(18,2)) AS vlr_arr_tsd
FROM v_item""",
    "v_nfse": """
SELECT user_id + 2000000 AS inscr_merc_pres_uni, 2018 + event_id % 6 AS ano FROM {events}""",
    "v_parcelamento": """
SELECT CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_orderkey END AS termo_da_unico, l_linestatus AS cterdiseri,
  CASE WHEN l_orderkey % 3 <> 0 THEN o_custkey END AS adimovsequ,
  CASE WHEN l_orderkey % 3 = 0 THEN o_custkey END AS admercsequ, vlr_total AS vl_lanc_principal,
  vlr_pago AS vl_arr_principal, CASE WHEN o_orderpriority = '1-URGENT' THEN 'SIM' ELSE 'NAO' END AS fpropaprot,
  CASE WHEN o_orderpriority = '2-HIGH' THEN l_shipdate END AS dt_ajuizamento, l_shipdate AS dt_parcelamento,
  l_linenumber - 1 AS qtd_reparcelamentos
FROM v_item""",
    # Scored stock with a closed-form index, for the rating tables.
    "v_score": """
SELECT cda, tipo_divida, id_pessoa, da_aberto, valor_tot AS valor_total_da, idade_divida,
  id_pessoa % 5 AS classe_5, id_pessoa % 6 AS classe_6, id_pessoa % 7 AS classe_7,
  CASE WHEN id_pessoa % 11 = 0 THEN 0 ELSE CAST((cda*7 + id_pessoa*13) % 1001 AS DOUBLE)/1000 END AS igr
FROM v_divida""",
    # Predictions with a closed-form error, for residual studies.
    "v_resid": """
SELECT cda, da_aberto, y, CASE WHEN cda % 10 < 2 THEN y ELSE y*0.75e0 + CAST((cda*7) % 250 AS DOUBLE)/1000 END AS y_predict
FROM (SELECT cda, da_aberto, CAST(floor(CAST(valor_pago AS DOUBLE)/CAST(valor_tot AS DOUBLE)*1000) AS DOUBLE)/1000 AS y
  FROM v_divida) t""",
}


def _needed(text: str, found: list[str]) -> list[str]:
    """Views that a text names, each after the ones it builds on."""
    for name in VIEWS:
        if re.search(rf"\b{name}\b", text) and name not in found:
            _needed(VIEWS[name], found)
            if name not in found:
                found.append(name)
    return found


def with_views(query: str, tables: dict[str, str]) -> str:
    """Prefix a query with the views it names; ``tables`` maps base tables to what the engine reads."""
    clauses = [f"{name} AS ({VIEWS[name].format(**tables)})" for name in _needed(query, [])]
    body = query.strip()
    if body[:5].upper() == "WITH ":
        clauses.append(body[5:])
        return "WITH " + ",\n".join(clauses)
    return ("WITH " + ",\n".join(clauses) + "\n" if clauses else "") + body


class Source:
    """Base tables and domain views of one data folder, as lazy data frames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def size(self) -> int:
        """Bytes of the tables that the views read."""
        places = [self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet") for name in VIEWED_TABLES]
        files = places[0].getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sum(files.getContentSummary(place).getLength() for place in places if files.exists(place))

    def view(self, name: str) -> DataFrame:
        text = with_views(f"SELECT * FROM {name}", {t: "{" + t + "}" for t in BASE_TABLES})
        frames = {t: self.table(t) for t in BASE_TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **frames)

    def __getattr__(self, name: str) -> DataFrame:
        if f"v_{name}" in VIEWS:
            return self.view(f"v_{name}")
        if name in BASE_TABLES:
            return self.table(name)
        raise AttributeError(name)
