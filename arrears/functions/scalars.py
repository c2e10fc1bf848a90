"""Scalar derivations on bills, certificates and keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions.semantics import holds, last_wins


def trimmed_equals(col: str, text: str) -> Column:
    return F.trim(F.col(col)) == text


def compose_key(kind: str, *parts: str) -> Column:
    """``kind-`` followed by the parts; missing parts are skipped as the source database does."""
    return F.concat_ws("", F.lit(f"{kind}-"), *[F.col(p).cast("string") for p in parts])


def compose_key_strict(*parts: Column | str) -> Column:
    """Dash-joined key that is missing as soon as one part is."""
    columns = [F.col(p).cast("string") if isinstance(p, str) else p for p in parts]
    return reduce(lambda left, right: F.concat(left, F.lit("-"), right), columns)


def digits_only(col: str) -> Column:
    """Digits of a text as a number; missing when there are none or too many."""
    return F.regexp_replace(F.col(col), r"\D", "").try_cast("bigint")


def interval_label(low: str, high: str) -> Column:
    return F.format_string("[%s, %s)", F.col(low).cast("string"), F.col(high).cast("string"))


def parsed_year(col: str) -> Column:
    return F.year(F.try_to_timestamp(F.col(col).cast("string")))


def age_in_years(year: Column, reference_year: int) -> Column:
    """Age against an explicit reference year, never against the clock of the run."""
    return F.lit(reference_year) - year


def money_text(col: Column | str, symbol: str = "R$") -> Column:
    """1234567.891 → ``R$ 1.234.567,89``; presentation only."""
    number = F.format_number(F.col(col) if isinstance(col, str) else col, 2)
    return F.concat(F.lit(f"{symbol} "), F.translate(number, ",.", ".,"))


def percent_text(col: Column | str) -> Column:
    number = F.format_number(F.col(col) if isinstance(col, str) else col, 2)
    return F.concat(F.translate(number, ",.", ".,"), F.lit("%"))


def decimal_comma(col: str) -> Column:
    return F.regexp_replace(F.col(col).cast("string"), r"\.", ",")


def code_map(col: str, mapping: dict) -> Column:
    """Value of a fixed dictionary, missing for keys outside it."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.col(col))


def size_class(kind: str = "tipo_propriedade", area: str = "area_construida") -> Column:
    """Size of a property from its type and built area; a missing area counts as large."""
    a = F.col(area)
    expression = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, low, small, medium in fv.PROPERTY_SIZES:
        is_small = a <= small
        if low is not None:
            mode, bound = low
            is_small = is_small & ((a > bound) if mode == "above" else (a >= bound))
        is_medium = (a > small) & (a <= medium)
        size = (
            F.when(holds(is_small), F.lit("PEQUENO"))
            .when(holds(is_medium), F.lit("MEDIO"))
            .otherwise(F.lit("GRANDE"))
        )
        expression = expression.when(F.col(kind) == name, size)
    return expression.otherwise(F.lit("INDEFINIDO"))


def land_size(kind: str, size: str) -> Column:
    """Bills without a property type are land."""
    return F.when(F.col(kind).isNull(), F.lit(fv.LAND_SIZE)).otherwise(F.col(size))


def single_quota(paid_on: str, paid: str, billed: str, year: str) -> Column:
    """1 when the whole bill was paid in January of its own year."""
    return holds(
        (F.month(paid_on) == 1) & (F.col(paid) == F.col(billed)) & (F.year(paid_on) == F.col(year))
    ).cast("int")


def payment_status(paid: str = "vlr_pago", billed: str = "vlr_total_dam") -> Column:
    p, b = F.col(paid), F.col(billed)
    return (
        F.when(p == b, F.lit("paga"))
        .when(p == 0, F.lit("nao_paga"))
        .when((p > 0) & (p < b), F.lit("parcial"))
        .when(p > b, F.lit("paga_a_maior"))
    )


def open_flag(billed: str, paid: str) -> Column:
    return (~F.col(billed).eqNullSafe(F.col(paid))).cast("int")


def accessibility_profile() -> Column:
    """0 to 2: how reachable the debtor is through business activity or a building."""
    business = F.col("tipo_divida") == "mercantil"
    property_ = F.col("tipo_divida") == "imovel"
    invoices = F.coalesce(F.col("qtd_notas_2anos"), F.lit(0))
    building = F.coalesce(F.col("edificacao"), F.lit(0))
    active = F.col("situacao").eqNullSafe("ATIVO")
    return last_wins([
        (business & (invoices > 0) & active, 2),
        (business & (invoices > 0) & ~active, 1),
        (business & (invoices == 0) & active, 1),
        (business & (invoices == 0) & ~active, 0),
        (property_ & (building == 1), 2),
        (property_ & (building == 0), 0),
    ])


def accessibility_score(profile: str = "perfil_acessivel") -> Column:
    """Profile + known id + known address, overwritten in order by three special cases."""
    known_id = F.coalesce(F.col("cpf_cnpj_existe"), F.lit(0))
    no_profile = holds(F.col(profile) == 0)
    return last_wins(
        [
            (known_id == 0, 0),
            ((F.col("tipo_divida") == "mercantil") & no_profile, 0),
            ((F.col("tipo_divida") == "imovel") & no_profile, 1),
        ],
        otherwise=F.col(profile) + known_id + F.col("endereco_existe"),
    )


def accessibility_label(score: str = "situacao_cobranca") -> Column:
    return code_map(score, fv.ACCESSIBILITY_LABELS)
