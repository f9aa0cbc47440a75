"""Text expressions: engine descriptions, label clean-up, model names."""

from pyspark.sql import Column, functions as F

# --- fixed values: patterns and display names -------------------------------------------
DISPLACEMENT = r"(\d\.\d)L"
DISPLACEMENT_LOOSE = r"([\d\.]+)L"
MODEL_NAMES = [
    ("LinearRegression", "Linear Regression"),
    ("GBTRegression", "Gradient-Boosted Trees"),
    ("GBTRegressor", "Gradient-Boosted Trees"),
]
# -----------------------------------------------------------------------------------------


def quoted(name: str) -> str:
    """Column name for use in a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """Text constant for use in a SQL expression."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def engine_displacement(source) -> Column:
    """Litres from text such as ``I4 2.0L``: one digit either side of the point, first match."""
    return F.expr(f"try_cast(nullif(regexp_extract(`{source}`, '{_sql(DISPLACEMENT)}', 1), '')"
                  " as double)")


def engine_configuration(source) -> Column:
    """What is left of the engine text once displacements are taken out.

    NULL when nothing is left beside a displacement; a text that never held one is kept as is.
    """
    rest = F.trim(F.regexp_replace(F.col(source), DISPLACEMENT, ""))
    return F.when((rest == "") & F.col(source).rlike(DISPLACEMENT), None).otherwise(rest)


def displacement_loose(source) -> Column:
    """Litres with any number of digits; NULL when the matched text is not a number."""
    return F.expr(f"try_cast(nullif(regexp_extract(`{source}`, '{_sql(DISPLACEMENT_LOOSE)}', 1),"
                  " '') as double)")


def _sql(pattern):
    return pattern.replace("\\", "\\\\")


def null_to_label(column, label) -> Column:
    return F.coalesce(F.col(column), F.lit(label))


def tidy_text(column) -> Column:
    """One-line text: tab, newline and carriage return become spaces, NULL and 'nan' become ''."""
    flat = F.translate(F.col(column), "\t\n\r", "   ")
    return F.when(F.col(column).isNull() | (flat == "nan"), "").otherwise(flat)


def model_display_name(column) -> Column:
    """Readable model name for a class name or path that contains it."""
    c = F.col(column)
    picked = [F.when(c.contains(part), shown) for part, shown in MODEL_NAMES]
    return F.coalesce(*picked, c)
