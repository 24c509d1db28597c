"""DuckDB-runnable SQL that states each registered query independently.

The driver's tables are pre-registered as views; the five silver sources and
the three gold tables are written here as CTEs over them, so every oracle
starts from the raw tables. Rules that make the two engines agree exactly:
money is DECIMAL until the output cast, DuckDB's HUGEINT sums are cast to
BIGINT, and the ticket is rounded half-up in integer cents.
"""

from __future__ import annotations

# Standard arguments of the test queries (FIXTURES.md §3).
PROCESSING_DATE = "1998-03-01"
BRANCHES = ("NATION_1", "NATION_2", "NATION_3")
PRODUCT = 7
DATE_FROM = "1996-01-01"
DATE_TO = "1998-12-01"

_BRANCH = """lineitem JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation ON s_nationkey = n_nationkey"""
_MONTH = "CAST(date_trunc('month', l_shipdate) AS DATE)"
_PRODUCT = "CAST(l_partkey % 50 + 1 AS INT)"
_ORDER_LINE = ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
               "CAST(l_quantity AS INT))")

SILVER = {
    "vendas": f"""
SELECT {_MONTH} AS data_venda, {_PRODUCT} AS produto_id, n_name AS filial_id,
       CAST(l_quantity AS INT) AS quantidade,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS valor_unitario
FROM {_BRANCH}""",
    "estoque": f"""
SELECT {_PRODUCT} AS produto_id, n_name AS filial_id,
       CAST(l_quantity AS INT) AS quantidade_disponivel, {_MONTH} AS data_referencia
FROM {_BRANCH}
WHERE l_linestatus = 'O'""",
    "devolucao": f"""
SELECT {_ORDER_LINE} AS pedido_id, {_PRODUCT} AS produto_id,
       CAST(l_quantity AS INT) AS quantidade, o_orderpriority AS motivo,
       {_MONTH} AS data_devolucao, n_name AS filial_id
FROM {_BRANCH}
     JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'R'""",
    "frete": f"""
SELECT {_ORDER_LINE} AS pedido_id,
       CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
            AS DECIMAL(18,4)) AS valor_frete,
       {_MONTH} AS data_envio,
       CASE l_linenumber % 4 WHEN 0 THEN 'Correios' WHEN 1 THEN 'JadLog' WHEN 2 THEN 'Loggi'
            ELSE 'Mandae' END AS transportadora,
       n_name AS filial_id
FROM {_BRANCH}""",
    "tributos": f"""
SELECT {_MONTH} AS data_pagamento,
       CASE l_partkey % 8 WHEN 0 THEN 'ICMS' WHEN 1 THEN 'ISS' WHEN 2 THEN 'PIS'
            WHEN 3 THEN 'COFINS' WHEN 4 THEN 'IRPJ' WHEN 5 THEN 'CSLL' WHEN 6 THEN 'INSS'
            ELSE 'IPI' END AS tipo_imposto,
       CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                  * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,4)) AS valor_pago,
       n_name AS filial_id
FROM {_BRANCH}""",
}


def ticket_sql(amount: str, units: str, scale: int = 100) -> str:
    """round(amount/scale / units, 2) half-up, exact, NULL for zero units; ``amount`` is a whole number of 1/scale."""
    per = scale // 100
    return (f"CASE WHEN {units} = 0 THEN NULL ELSE "
            f"CAST((CASE WHEN ({amount} < 0) <> ({units} < 0) THEN -1 ELSE 1 END) * "
            f"((2 * abs({amount}) + {per} * abs({units})) // ({2 * per} * abs({units}))) AS DOUBLE) / 100 END")


AGG_RETURNS = """
SELECT data_devolucao AS CodigoData, produto_id AS ProdutoId, filial_id AS FilialId,
       CAST(sum(quantidade) AS BIGINT) AS TotalDevolvido
FROM devolucao GROUP BY 1, 2, 3"""

AGG_STOCK = """
SELECT data_referencia AS CodigoData, produto_id AS ProdutoId, filial_id AS FilialId,
       CAST(sum(quantidade_disponivel) AS BIGINT) AS TotalEmEstoque
FROM estoque GROUP BY 1, 2, 3"""


def agg_sales_sql(source: str = "vendas", scale: int = 100) -> str:
    return f"""
SELECT CodigoData, ProdutoId, FilialId, TotalQuantidadeVendida,
       CAST(round(v, 2) AS DOUBLE) AS TotalValorVendido,
       {ticket_sql(f'CAST(v * {scale} AS BIGINT)', 'TotalQuantidadeVendida', scale)} AS TicketMedio
FROM (SELECT data_venda AS CodigoData, produto_id AS ProdutoId, filial_id AS FilialId,
             CAST(sum(quantidade) AS BIGINT) AS TotalQuantidadeVendida,
             sum(valor_unitario) AS v
      FROM {source} GROUP BY 1, 2, 3) s"""


GOLD_PRODUCT = """
SELECT r.CodigoData, r.ProdutoId, r.FilialId, r.TotalDevolvido, e.TotalEmEstoque,
       s.TotalQuantidadeVendida, s.TotalValorVendido, s.TicketMedio
FROM agg_returns r
JOIN agg_stock e USING (CodigoData, ProdutoId, FilialId)
JOIN agg_sales s USING (CodigoData, ProdutoId, FilialId)"""

GOLD_FREIGHT = """
SELECT data_envio AS CodigoData, filial_id AS FilialId, transportadora AS Transportadora,
       CAST(round(sum(valor_frete), 4) AS DOUBLE) AS TotalFretePago
FROM frete GROUP BY 1, 2, 3"""

GOLD_TAXES = """
SELECT data_pagamento AS CodigoData, filial_id AS FilialId, tipo_imposto AS TipoImposto,
       CAST(round(sum(valor_pago), 4) AS DOUBLE) AS TotalImpostoPago
FROM tributos GROUP BY 1, 2, 3"""

CTES = {
    **SILVER,
    "agg_returns": AGG_RETURNS,
    "agg_stock": AGG_STOCK,
    "agg_sales": agg_sales_sql(),
    "gold_product": GOLD_PRODUCT,
    "gold_freight": GOLD_FREIGHT,
    "gold_taxes": GOLD_TAXES,
}

# Which CTEs each CTE needs, in definition order.
_DEPENDS = {
    "agg_returns": ["devolucao"],
    "agg_stock": ["estoque"],
    "agg_sales": ["vendas"],
    "gold_product": ["devolucao", "estoque", "vendas", "agg_returns", "agg_stock", "agg_sales"],
    "gold_freight": ["frete"],
    "gold_taxes": ["tributos"],
}


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the named CTEs (and what they need), then ``body``."""
    order: list[str] = []
    for n in names:
        for dep in _DEPENDS.get(n, []) + [n]:
            if dep not in order:
                order.append(dep)
    defs = {**CTES, **(extra or {})}
    parts = [f"{n} AS ({defs[n]})" for n in order]
    for n, sql in (extra or {}).items():
        if n not in order:
            parts.append(f"{n} AS ({sql})")
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


def in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)
