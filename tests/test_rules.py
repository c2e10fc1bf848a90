"""Rule tables over grids of boundary values."""

import itertools

import pytest

from arrears.functions import fixed_values as fv
from arrears.functions import scalars as S
from arrears.functions.ratings import RULE_TABLES, collection_action, quantile_rating, rating


def assigned_in_order(variant, klass, igr):
    """Masked assignments one after the other, each overwriting the last."""
    level = "BAIXISSIMA" if igr == 0 else None
    for number, low, high, name in RULE_TABLES[variant]:
        above = igr != 0 if low is None else (igr is not None and igr >= low)
        below = high is None or (igr is not None and igr < high)
        if klass == number and above and below:
            level = name
    return level


@pytest.mark.parametrize("variant", list(RULE_TABLES))
def test_rating_grid(spark, variant):
    cuts = {c for _, low, high, _ in RULE_TABLES[variant] for c in (low, high) if c is not None}
    values = sorted({0.0, 1.0} | {round(c + d, 3) for c in cuts for d in (-0.001, 0, 0.001)}) + [None]
    grid = [(k, v) for k in [*range(8), None] for v in values]
    df = spark.createDataFrame(grid, "class_contribuinte int, igr double")
    found = [r[0] for r in df.select(rating(variant)).collect()]
    assert found == [assigned_in_order(variant, k, v) for k, v in grid]


def test_known_ratings(spark):
    df = spark.createDataFrame([(4, 0.3), (4, 0.299), (4, 0.099), (1, 0.001), (3, 0.0), (2, 0.5)], "class_contribuinte int, igr double")
    assert [r[0] for r in df.select(rating("v1")).collect()] == ["ALTA", "MEDIA", "BAIXA", "BAIXA", "BAIXISSIMA", "ALTISSIMA"]
    overlap = spark.createDataFrame([(1, 0.07), (1, 0.1)], "class_contribuinte int, igr double")
    assert [r[0] for r in overlap.select(rating("v15")).collect()] == ["BAIXA", "MEDIA"]


def test_quantile_rating(spark):
    df = spark.createDataFrame(
        [(1, 0.0), (1, 0.2), (1, 0.4), (1, 0.6), (1, 0.8), (2, 0.01), (0, 0.9), (4, 0.0), (3, 0.5), (3, 0.0)],
        "class_contribuinte int, igr double")
    found = {(r["class_contribuinte"], r["igr"]): r["rating_divida"] for r in quantile_rating(df).collect()}
    assert found == {(1, 0.0): "BAIXISSIMA", (1, 0.2): "MEDIA", (1, 0.4): "ALTA", (1, 0.6): "ALTISSIMA", (1, 0.8): "ALTISSIMA",
                     (2, 0.01): "ALTISSIMA", (0, 0.9): "BAIXA", (4, 0.0): "ALTA", (3, 0.5): "ALTA", (3, 0.0): "BAIXISSIMA"}


def accessibility_by_hand(kind, invoices, status, building, known, address):
    invoices, building, known = invoices or 0, building or 0, known or 0
    if kind == "mercantil":
        profile = (2 if status == "ATIVO" else 1) if invoices > 0 else (1 if status == "ATIVO" else 0)
    else:
        profile = {1: 2, 0: 0}[building]
    score = profile + known + address
    if known == 0:
        score = 0
    if kind == "mercantil" and profile == 0:
        score = 0
    if kind == "imovel" and profile == 0:
        score = 1
    return profile, score


def test_accessibility_grid(spark):
    grid = list(itertools.product(["imovel", "mercantil"], [0, 1, None], ["ATIVO", "INAPTO", None], [0, 1, None], [0, 1, None], [0, 1]))
    df = spark.createDataFrame(grid, "tipo_divida string, qtd_notas_2anos int, situacao string, edificacao int, cpf_cnpj_existe int, endereco_existe int")
    scored = df.withColumn("perfil_acessivel", S.accessibility_profile()).withColumn("s", S.accessibility_score())
    assert [(r["perfil_acessivel"], r["s"]) for r in scored.collect()] == [accessibility_by_hand(*g) for g in grid]


def test_size_grid(spark):
    cases = [
        ("APARTAMENTO", 60, "PEQUENO"), ("APARTAMENTO", 61, "MEDIO"), ("APARTAMENTO", 100, "MEDIO"), ("APARTAMENTO", 101, "GRANDE"),
        ("APARTAMENTO", None, "GRANDE"), ("CASA", 100, "PEQUENO"), ("CASA", 200, "MEDIO"), ("CASA", 201, "GRANDE"),
        ("LOJA", 50, "PEQUENO"), ("LOJA", 200, "MEDIO"), ("LOJA", 201, "GRANDE"), ("GARAGEM COMERCIAL", 500, "PEQUENO"),
        ("GARAGEM COMERCIAL", 2000, "MEDIO"), ("GARAGEM COMERCIAL", 2001, "GRANDE"), ("GALPÃO", 200, "GRANDE"), ("GALPÃO", 201, "PEQUENO"),
        ("GALPAO", 500, "PEQUENO"), ("GALPAO", 501, "MEDIO"), ("GALPAO", 2001, "GRANDE"), ("SALA", 19, "GRANDE"), ("SALA", 20, "PEQUENO"),
        ("SALA", 50, "PEQUENO"), ("SALA", 150, "MEDIO"), ("SALA", 151, "GRANDE"), ("OUTRO", 10, "INDEFINIDO"), (None, 10, "INDEFINIDO"),
    ]
    df = spark.createDataFrame([(k, a) for k, a, _ in cases], "tipo_propriedade string, area_construida int")
    assert [r[0] for r in df.select(S.size_class()).collect()] == [size for _, _, size in cases]


def test_action_grid(spark):
    values = [999.99, 1000.0, 2999.99, 3000.0, 49999.99, 50000.0, 199999.99, 200000.0]
    df = spark.createDataFrame([(k, v) for k in ("imovel", "mercantil") for v in values], "tipo_divida string, valor_total_da double")
    assert [r[0] for r in df.select(collection_action()).collect()] == [
        None, "negativar", "negativar", "protesto", "protesto", "ajuizamento", "ajuizamento", "ajuizamento",
        None, "negativar", "negativar", "protesto", "protesto", "protesto", "protesto", "ajuizamento"]


def test_labels(spark):
    df = spark.createDataFrame([(i,) for i in range(6)], "situacao_cobranca int")
    assert [r[0] for r in df.select(S.accessibility_label()).collect()] == [*fv.ACCESSIBILITY_LABELS.values(), None]
