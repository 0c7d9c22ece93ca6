"""Recency, frequency, monetary scoring and the next best action per customer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RfmThresholds:
    """Limits for scores 5, 4, 3 and 2; anything beyond the last scores 1."""

    # Default score limits.
    recency_days: tuple[int, ...] = (90, 180, 270, 360)
    orders: tuple[int, ...] = (5, 4, 3, 2)
    gross: tuple[int, ...] = (300000, 200000, 100000, 10000)
    months: int = 12


# Segments in the order they are tried; the first that holds wins, else Lost.
# Two of them (New Customers, Cant Lose Them) are always preceded by a wider one.
SEGMENT_RULES = (
    ("Champions", "r >= 5 AND fm > 4"),
    ("Loyal Customers", "r > 2 AND fm > 3"),
    ("Potential Loyalist", "r > 3 AND fm BETWEEN 1 AND 3"),
    ("New Customers", "r >= 5 AND fm <= 1"),
    ("Promising", "r BETWEEN 3 AND 4 AND fm <= 1"),
    ("Needing Attention", "r BETWEEN 3 AND 4 AND fm BETWEEN 2 AND 3"),
    ("About to Sleep", "r BETWEEN 2 AND 3 AND fm <= 2"),
    ("At Risk", "r <= 2 AND fm > 4"),
    ("Cant Lose Them", "r <= 1 AND fm > 4"),
    ("Hibernating", "r BETWEEN 1 AND 2 AND fm BETWEEN 1 AND 2"),
)
OTHER_SEGMENT = "Lost"


def _score(value: Column, limits: Sequence[int], smaller_is_better: bool) -> Column:
    column = F
    for points, limit in zip((5, 4, 3, 2), limits, strict=True):
        column = column.when(value <= limit if smaller_is_better else value >= limit, points)
    return column.otherwise(1)


def segment() -> Column:
    """Segment name from columns ``r`` and ``fm``."""
    column = F
    for name, condition in SEGMENT_RULES:
        column = column.when(F.expr(condition), name)
    return column.otherwise(OTHER_SEGMENT)


def customer_rfm(sales: DataFrame, limits: RfmThresholds = RfmThresholds()) -> DataFrame:
    """One row per customer who bought in the last months before the newest sale.

    The newest sale is a scalar subquery, so the window is a plain filter that Catalyst moves
    below the joins that make up the fact. Stored sales are filtered by year as well, which is the
    column they are partitioned by, so only the folders of the window are read.
    """
    anchor = sales.agg(F.max("order_date")).scalar()
    since = F.add_months(anchor, -limits.months)
    recent = sales.filter(F.col("order_date") >= since)
    if "order_year" in sales.columns:
        recent = recent.filter(F.col("order_year") >= F.year(since))
    base = recent.groupBy("customer_key").agg(
        F.max("order_date").alias("last_purchase"),
        F.count_distinct("sales_order_number").alias("sales_orders_12m"),
        F.sum("gross_sales").alias("gross_sales_12m"),
    )
    scored = base.select(
        "customer_key",
        "last_purchase",
        F.date_diff(anchor, "last_purchase").alias("recency_days"),
        "sales_orders_12m",
        "gross_sales_12m",
    ).withColumns(
        {
            "r": _score(F.col("recency_days"), limits.recency_days, True),
            "f": _score(F.col("sales_orders_12m"), limits.orders, False),
            "m": _score(F.col("gross_sales_12m"), limits.gross, False),
        }
    )
    return scored.withColumn("fm", (F.col("f") + F.col("m")) / 2.0).withColumn("segment", segment())


def rfm_score(sales: DataFrame, limits: RfmThresholds = RfmThresholds()) -> DataFrame:
    """The three scores as one struct per customer."""
    return customer_rfm(sales, limits).select("customer_key", F.struct("r", "f", "m").alias("score"))


def segment_counts(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("qtd_clientes"), F.sum("gross_sales_12m").alias("gross_sales_12m")
    )


def customers_of_segment(
    rfm: DataFrame, customers: DataFrame, geography: DataFrame, lines: DataFrame, product: DataFrame, name: str
) -> DataFrame:
    """Named customers of a segment who have a located sale of a known product.

    The segment is cut first and names come from the dimension. What the flat view would demand of a
    customer is a semi join on distinct (customer, product) pairs of the lines.
    """
    chosen = rfm.filter(F.col("segment") == name)
    pairs = lines.select("customer_key", "product_key").distinct()
    active = pairs.join(product.select("product_key"), "product_key", "left_semi")
    located = customers.join(geography.select("geography_key"), "geography_key", "left_semi")
    return (
        chosen.join(active, "customer_key", "left_semi")
        .join(located.select("customer_key", "customer_name"), "customer_key")
        .select("customer_name", "recency_days", "sales_orders_12m", "gross_sales_12m", "segment")
        .distinct()
    )


def register_customer_segment(spark: SparkSession, rfm: DataFrame, view: str = "customer_rfm") -> None:
    """SQL sugar: ``customer_segment(key)`` over the RFM table as a temporary function."""
    rfm.createOrReplaceTempView(view)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION customer_segment(p_customer_key BIGINT)
            RETURNS STRING RETURN
            (SELECT max(segment) FROM {view} WHERE customer_key = p_customer_key)"""
    )


# Action shown per segment (segment, intent, lever, rationale, base priority).
ACTIONS = (
    (
        "Champions",
        "Reter & expandir",
        "Assinatura dos itens core (whey/creatina), acesso VIP a lançamentos, pedir indicação",
        "Melhores clientes: recompra recente e alto valor. Reter e ampliar ticket. (Assinatura/VIP = capacidade a criar.)",
        "Alta",
    ),
    (
        "Cant Lose Them",
        "Reconquistar (urgente)",
        "Contato direto (1:1) + oferta forte na recompra dos produtos habituais",
        "Eram muito valiosos e sumiram. Risco alto de perda definitiva.",
        "Alta",
    ),
    (
        "At Risk",
        "Reconquistar",
        "Lembrete de reposição + desconto no reabastecimento dos itens usuais",
        "Bom histórico, recência caindo: provável que o pote acabou e não voltou.",
        "Alta",
    ),
    (
        "Loyal Customers",
        "Expandir",
        "Cross-sell de stack (quem toma whey -> creatina/pré-treino), assinatura",
        "Compram com constância. Crescer categorias e fixar recompra.",
        "Média",
    ),
    (
        "Potential Loyalist",
        "Desenvolver / fidelizar",
        "Empurrar 2ª/3ª compra, bundle proteína + coqueteleira, apresentar assinatura",
        "Recentes e promissores. Consolidar o hábito de recompra.",
        "Média",
    ),
    (
        "Needing Attention",
        "Reengajar",
        'Lembrete "seu estoque acabou?" + oferta por tempo limitado',
        "Frequência/valor médios com recência em queda. Reativar antes de esfriar.",
        "Média",
    ),
    (
        "About to Sleep",
        "Reengajar",
        "Win-back leve: cupom de reabastecimento",
        "Recência baixa. Janela curta antes de virar inativo.",
        "Média",
    ),
    (
        "New Customers",
        "Onboarding",
        "Educar sobre uso/stack + cupom para a 2ª compra",
        "Compra recente, ainda sem hábito. Converter em recorrente.",
        "Média",
    ),
    (
        "Promising",
        "Nutrir",
        "Conteúdo + oferta para aumentar a frequência",
        "Recência ok, mas baixa frequência/valor. Desenvolver.",
        "Baixa",
    ),
    (
        "Hibernating",
        "Reativar barato ou soltar",
        "Campanha de e-mail/oferta de baixo custo",
        "Inativos de baixo engajamento. Investir pouco.",
        "Baixa",
    ),
    (
        "Lost",
        "Desprioritizar",
        "Só em campanha ampla de winback",
        "Sem recência e baixo engajamento. Menor ROI de esforço.",
        "Baixa",
    ),
)
PRIORITIES = ("Alta", "Média", "Baixa")
HIGH_VALUE_SCORE = 4


def customer_actions(rfm: DataFrame) -> DataFrame:
    """Each customer's action; customers of high monetary score move up one priority level."""
    actions = rfm.sparkSession.createDataFrame(
        ACTIONS, "segment string, intent string, suggested_lever string, rationale string, base_priority string"
    )
    base = F.col("base_priority")
    raised = F.when(base == "Baixa", "Média").when(base.isNotNull(), "Alta")
    return (
        rfm.join(F.broadcast(actions), "segment", "left")  # eleven rows
        .withColumn("priority", F.when(F.col("m") >= HIGH_VALUE_SCORE, raised).otherwise(base))
        .select(
            "customer_key", "segment", "intent", "suggested_lever", "rationale", "priority",
            "recency_days", "sales_orders_12m", "gross_sales_12m",
        )
    )


def served_actions(actions: DataFrame, segment_name: str | None = None, limit: int = 100) -> DataFrame:
    """The most urgent customers first, largest first within a priority."""
    if segment_name is not None:
        actions = actions.filter(F.col("segment") == segment_name)
    urgency = F.when(F.col("priority") == "Alta", 1).when(F.col("priority") == "Média", 2).otherwise(3)
    return (
        actions.orderBy(urgency, F.col("gross_sales_12m").desc(), "customer_key")
        .limit(limit)
        .select("customer_key", "segment", "intent", "suggested_lever", "priority", "gross_sales_12m")
    )
