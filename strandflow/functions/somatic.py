"""Somatic variant rules over columns qual, info, tumor and normal; the last three are maps of text by field name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import tags


def number(fields: str, key: str) -> Column:
    """A field as a double; null where it is missing or no number."""
    return F.try_element_at(F.col(fields), F.lit(key)).try_cast("double")


def numbers(fields: str, key: str) -> Column:
    """A comma-separated field as doubles; null where it is missing."""
    text = F.try_element_at(F.col(fields), F.lit(key))
    return F.when(text != ".", F.transform(F.split(text, ","), lambda x: x.try_cast("double")))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _below(fields: str, key: str):
    return lambda least: number(fields, key) < least


# Identifier and description, parameters, field names.
RULES: list[tags.Rule] = [
    ("low_qual", ("min_qual",), lambda x: F.col("qual") < x),
    ("low_depth", ("min_depth",), lambda x: total(numbers("tumor", "AD")) < x),
    ("low_allele_frac", ("min_tumor_af",), _below("tumor", "AF")),
    ("alt_allele_in_normal", ("max_normal_af",), lambda x: number("normal", "AF") >= x),
    ("low_qual_by_depth", ("min_qd",), lambda x: F.col("qual") < x * total(F.slice(numbers("tumor", "AD"), 2, 1 << 20))),
    ("read_pos_bias", ("min_read_pos_ranksum",), _below("tumor", "ReadPosRankSumPS")),
    ("base_qual_bias", ("min_base_qual_ranksum",), _below("tumor", "BaseQRankSumPS")),
    ("neighbor_base_qual", ("min_neighbor_base_qual",), _below("tumor", "NBQPS")),
    ("map_qual_bias", ("min_map_qual_ranksum",), _below("tumor", "MQRankSumPS")),
    ("depth_high_conf", ("min_depth_high_conf",), _below("tumor", "ALTHC")),
    ("short_tandem_repeat", ("max_str_length",), lambda x: F.get(numbers("info", "RPA"), F.lit(0)) >= x),
    ("insignificant", ("max_pv", "max_pv2"), lambda x, y: (number("info", "PV") > x) & (number("info", "PV2") > y)),
    ("insignificant_str", ("max_str_pv",), lambda x: F.map_contains_key(F.col("info"), F.lit("STR")) & (number("info", "PV") > x)),
    ("orientation_bias", ("max_foxog",), lambda x: number("tumor", "FOXOG") >= x),
    ("strand_bias", ("max_sor",), lambda x: number("info", "SOR") > x),
    ("noisy_region", ("max_ecnt",), lambda x: number("info", "ECNT") > x),
]
# Descriptions of the identifiers in a header.
DESCRIPTIONS = {
    "low_qual": "Low quality score",
    "low_depth": "Low coverage depth",
    "low_allele_frac": "Low allele fraction in tumor",
    "alt_allele_in_normal": "Evidence seen in the normal sample",
    "low_qual_by_depth": "Low QUAL score normalized by allele depth",
    "read_pos_bias": "Alt vs. Ref read position bias",
    "base_qual_bias": "Alt Vs. Ref base quality bias",
    "neighbor_base_qual": "Low mean neighboring base quality",
    "map_qual_bias": "Alt Vs. Ref mapping qualities bias",
    "depth_high_conf": "Depth high conf",
    "short_tandem_repeat": "Short tandem repeat",
    "insignificant": "Insignificant call",
    "insignificant_str": "Insignificant call in STR regions",
    "orientation_bias": "Orientation bias",
    "strand_bias": "Strand bias",
    "noisy_region": "Variant in noisy region",
}

# Tags to clear and thresholds of each kind of assay.
PRESETS: dict[str, dict] = {
    "amplicon": {
        "clear": ["triallelic_site"],
        "max_pv": 0.1, "max_pv2": 0.1, "max_str_pv": 0.05, "max_foxog": 1, "max_sor": 3, "min_qual": 40, "max_str_length": 10, "max_ecnt": 10,
    },
    "ctdna": {
        "clear": ["triallelic_site"],
        "min_qual": 9.225, "min_read_pos_ranksum": -2.78, "min_base_qual_ranksum": -5.85, "min_depth_high_conf": 3.5, "min_qd": 9.9,
    },
    "ctdna_umi": {
        "clear": ["triallelic_site"],
        "min_neighbor_base_qual": 47.7, "min_qual": 11.2, "min_read_pos_ranksum": -2.14, "min_base_qual_ranksum": -5.02, "min_depth_high_conf": 4.5,
    },
    "tissue_panel": {
        "clear": ["triallelic_site"],
        "max_pv": 0.1, "max_pv2": 0.1, "max_str_pv": 0.0025, "max_foxog": 1, "max_sor": 3, "min_qual": 200, "max_str_length": 10, "min_read_pos_ranksum": -8, "max_normal_af": 0.01,
    },
}


def chosen(preset: str | None = None, clear: str | list[str] | None = None, **params: float | None) -> tuple[dict, str | list[str]]:
    """Parameters of a preset, some replaced, and the tags to clear."""
    out = dict(PRESETS[preset]) if preset else {}
    cleared = out.pop("clear", "none") if clear is None else clear
    out.pop("clear", None)
    out |= params
    unknown = set(out) - {p for _, needs, _ in RULES for p in needs}
    if unknown:
        raise ValueError(f"unknown parameters: {', '.join(sorted(unknown))}")
    return out, cleared


def filtered(df: DataFrame, preset: str | None = None, clear: str | list[str] | None = None, **params: float | None) -> DataFrame:
    """df with its filter column retagged by a preset, by parameters, or by a preset with some parameters replaced.

    A rule whose value is missing does not tag; without a normal sample (null map) its rule never does.
    """
    values, cleared = chosen(preset, clear, **params)
    return tags.tagged(df, RULES, values, clear=cleared)


def declarations(values: dict) -> list[str]:
    """Header lines of the rules that take part with these parameters."""
    return [f'##FILTER=<ID={name},Description="{DESCRIPTIONS[name]}">' for name, needs, _ in sorted(RULES, key=lambda r: r[0]) if all(values.get(p) is not None for p in needs)]


def samples(vcf: DataFrame, names: list[str], tumor: str, normal: str | None = None) -> DataFrame:
    """Records with the maps of the named samples as tumor and normal; names are the header's, in order."""
    for s in (tumor, normal):
        if s is not None and s not in names:
            raise ValueError(f"no such sample: {s}")
    pick = lambda s: F.get("samples", F.lit(names.index(s))) if s is not None else F.lit(None).cast("map<string,string>")
    return vcf.withColumn("tumor", pick(tumor)).withColumn("normal", pick(normal))


#: A step of a chain: tag, what it is set on, and that as text; parameters in braces are replaced.
Step = tuple[str, Callable[[dict], Column], str]

# Tags and thresholds of the chain for whole genomes; min_qual is a parameter.
WHOLE_GENOME: list[Step] = [
    ("insignificant", lambda p: ((number("info", "PV") > 0.25) & (number("info", "PV2") > 0.25)) | (F.map_contains_key("info", F.lit("STR")) & (number("info", "PV") > 0.05)), "(PV>0.25 && PV2>0.25) || (INFO/STR == 1 && PV>0.05)"),
    ("orientation_bias", lambda p: number("tumor", "FOXOG") == 1, "FMT/FOXOG[0] == 1"),
    ("strand_bias", lambda p: number("info", "SOR") > 3, "SOR > 3"),
    ("low_qual", lambda p: F.col("qual") < p["min_qual"], "QUAL < {min_qual}"),
    ("short_tandem_repeat", lambda p: F.get(numbers("info", "RPA"), F.lit(0)) >= 10, "RPA[0]>=10"),
    ("noisy_region", lambda p: number("info", "ECNT") > 5, "ECNT>5"),
    ("read_pos_bias", lambda p: number("tumor", "ReadPosRankSumPS") < -8, "FMT/ReadPosRankSumPS[0] < -8"),
]
#: Parameters of chains where none are given.
CHAIN_PARAMS = {"min_qual": 200}


def steps(chain: list[Step], **params: float) -> list[tuple[str, Column, str]]:
    """A chain with its parameters filled in."""
    values = CHAIN_PARAMS | params
    return [(name, condition(values), about.format(**values)) for name, condition, about in chain]


def flag(df: DataFrame, steps: list[tuple[str, str | Column]], column: str = "filter") -> DataFrame:
    """Appends each tag whose condition (a column or an SQL expression) holds, PASS giving way to it; records without tags end as PASS."""
    out = F.array_except(F.coalesce(F.col(column), F.array().cast("array<string>")), F.array(F.lit("PASS")))
    found = [F.when(F.coalesce(F.expr(x) if isinstance(x, str) else x, F.lit(False)), F.lit(name)) for name, x in steps]
    out = F.array_union(out, F.array_compact(F.array(*found))) if found else out
    return df.withColumn(column, out).withColumn(column, F.when(F.size(column) == 0, F.array(F.lit("PASS"))).otherwise(F.col(column)))


def unflag(df: DataFrame, name: str, column: str = "filter") -> DataFrame:
    """Removes one tag."""
    return df.withColumn(column, F.array_remove(column, name))
