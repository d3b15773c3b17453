"""Column and table names."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame


# Runs of underscores shrink by these replacements, in this order.
SHRINK = (("__", "_"), ("___", "_"))


def only_word_characters(text: str, filler: str) -> str:
    """`text` with `filler` for every character but letters, digits and underscores."""
    return re.sub(r"\W", filler, text)


def sanitized(name: str) -> str:
    """A name of letters, digits and underscores; runs of underscores are shortened."""
    name = only_word_characters(name, "_")
    for run, shorter in SHRINK:
        name = name.replace(run, shorter)
    return name


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Safe column names in one projection; two names that become equal are an error."""
    names = [sanitized(c) for c in df.columns]
    lowered = [n.lower() for n in names]
    clash = sorted({n for n in names if lowered.count(n.lower()) > 1})
    if clash:
        raise ValueError(f"columns collide after cleaning: {clash}")
    return df.toDF(*names)


def cleaned_names(names: list[str]) -> list[str]:
    """snake_case ASCII names; `%` and `#` are spelled out, repeats get `_2`, `_3`, ..."""
    cleaned: list[str] = []
    for name in names:
        text = name.replace("%", "_percent_").replace("#", "_number_")
        text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
        text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
        text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
        text = re.sub(r"_+", "_", only_word_characters(text, "_")).strip("_").lower() or "x"
        if text[0].isdigit():
            text = "x" + text
        unused, n = text, 1
        while unused in cleaned:
            n += 1
            unused = f"{text}_{n}"
        cleaned.append(unused)
    return cleaned


def clean_names(df: DataFrame) -> DataFrame:
    """Columns renamed by position, so that duplicate names can be told apart."""
    return df.toDF(*cleaned_names(df.columns))


def table_name_from_folder(path: str) -> str:
    """Name for the table of a folder: `raw/sales_csv/` and the files in it give `sales`.

    A path that ends with `/` is the folder itself, any other one is a file in it. Letters,
    digits and underscores of the folder's name stay, in lower case and without `_csv`.
    """
    folder, _, _ = path.rpartition("/")
    name = only_word_characters(folder.rpartition("/")[2], "")
    return name.replace("_csv", "").lower()
