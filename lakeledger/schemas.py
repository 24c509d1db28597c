"""Declared column types, source specs and lake layout.

Every name here is part of the data contract of the lake (file names, table
folders, column names), so the values are fixed and stated together below.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

#: Amounts keep four decimals, as the gold totals do; nothing is rounded before a sum. With 18 digits Spark
#: computes in 64-bit numbers; an amount of 10**14 or more fails on load.
MONEY = T.DecimalType(18, 4)

# ---------------------------------------------------------------------------
# Source systems, silver tables and gold tables of the lake.
# Folder layout:  bronze/{system}/{table}/{prefix}_{YYYY_MM_DD}.csv
#                 silver/{domain}/{table}
#                 gold/{area}/{table}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class SourceSpec:
    """One daily source: where its file lands, its typed columns, how it loads."""

    name: str
    system: str
    domain: str
    table: str
    prefix: str
    date_column: str
    key_column: str | None
    append_only: bool
    buckets: int | None = None  # of the key, below the date: more for more rows a date (files of 128 MB and up)
    columns: tuple[tuple[str, T.DataType], ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, True) for c, t in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]


VENDAS = SourceSpec(
    name="vendas", system="sistema_vendas", domain="vendas", table="vendas",
    prefix="vendas", date_column="data_venda", key_column=None,
    append_only=True,
    columns=(
        ("data_venda", T.DateType()),
        ("produto_id", T.IntegerType()),
        ("filial_id", T.StringType()),
        ("quantidade", T.IntegerType()),
        ("valor_unitario", MONEY),
    ),
)

ESTOQUE = SourceSpec(
    name="estoque", system="sistema_estoque", domain="estoque", table="estoque",
    prefix="estoque", date_column="data_referencia", key_column=None,
    append_only=True,
    columns=(
        ("produto_id", T.IntegerType()),
        ("filial_id", T.StringType()),
        ("quantidade_disponivel", T.IntegerType()),
        ("data_referencia", T.DateType()),
    ),
)

DEVOLUCAO = SourceSpec(
    name="devolucao", system="sistema_devolucao", domain="devolucao", table="devolucao",
    prefix="devolucao", date_column="data_devolucao", key_column="pedido_id",
    append_only=False,
    columns=(
        ("pedido_id", T.StringType()),
        ("produto_id", T.IntegerType()),
        ("quantidade", T.IntegerType()),
        ("motivo", T.StringType()),
        ("data_devolucao", T.DateType()),
        ("filial_id", T.StringType()),
    ),
)

FRETE = SourceSpec(
    name="frete", system="sistema_frete", domain="frete", table="frete",
    prefix="frete", date_column="data_envio", key_column=None,
    append_only=True,
    columns=(
        ("pedido_id", T.StringType()),
        ("valor_frete", MONEY),
        ("data_envio", T.DateType()),
        ("transportadora", T.StringType()),
        ("filial_id", T.StringType()),
    ),
)

TRIBUTOS = SourceSpec(
    name="tributos", system="sistema_tributos", domain="tributos", table="tributos",
    prefix="tributos", date_column="data_pagamento", key_column=None,
    append_only=True,
    columns=(
        ("data_pagamento", T.DateType()),
        ("tipo_imposto", T.StringType()),
        ("valor_pago", MONEY),
        ("filial_id", T.StringType()),
    ),
)

SOURCES: dict[str, SourceSpec] = {
    s.name: s for s in (VENDAS, ESTOQUE, DEVOLUCAO, FRETE, TRIBUTOS)
}


@dataclass(frozen=True)
class GoldSpec:
    """One gold table: its folder, its silver inputs and its keys."""

    name: str
    area: str
    table: str
    inputs: tuple[str, ...]
    keys: tuple[str, ...]
    date_column: str = "CodigoData"


GOLD_PRODUTOS = GoldSpec(
    name="produtos", area="vendas", table="tb_gd_resumo_produtos_filiais",
    inputs=("devolucao", "estoque", "vendas"),
    keys=("CodigoData", "ProdutoId", "FilialId"),
)

GOLD_FRETES = GoldSpec(
    name="fretes", area="logistica", table="tb_gd_resumo_fretes_pagos",
    inputs=("frete",),
    keys=("CodigoData", "FilialId", "Transportadora"),
)

GOLD_IMPOSTOS = GoldSpec(
    name="impostos", area="tributario", table="tb_gd_resumo_impostos_pagos",
    inputs=("tributos",),
    keys=("CodigoData", "FilialId", "TipoImposto"),
)

GOLDS: dict[str, GoldSpec] = {g.name: g for g in (GOLD_PRODUTOS, GOLD_FRETES, GOLD_IMPOSTOS)}


@dataclass(frozen=True)
class Lake:
    """Root folder of the three layers. On a cluster this is a shared URI."""

    root: str

    def bronze_dir(self, src: SourceSpec) -> str:
        return f"{self.root}/bronze/{src.system}/{src.table}"

    def silver(self, src: SourceSpec | str) -> str:
        src = SOURCES[src] if isinstance(src, str) else src
        return f"{self.root}/silver/{src.domain}/{src.table}"

    def gold(self, spec: GoldSpec | str) -> str:
        spec = GOLDS[spec] if isinstance(spec, str) else spec
        return f"{self.root}/gold/{spec.area}/{spec.table}"
