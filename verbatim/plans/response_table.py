"""Entry 1 — wave master → long response table, for one panel.

Order of steps is part of the meaning and is kept:
zip text → State lookup → derived demographics → projection → gate → decode labels →
fill forward within respondent → drop gate → unpivot → non-empty filter.
(The gate runs before the fill, so values from non-consenting weeks never propagate;
decoding runs before the fill, so an unlabelled code becomes NULL and is then filled.)

``parity=True`` reproduces the reference's zip handling exactly (survey zips are not
padded, duplicate gazetteer zips fan out); the default normalises both sides and
keeps one State per zip.  ``relookup=True`` looks State up again from the carried zip
instead of carrying State and zip independently.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatim.functions.names import dotted_to_snake
from verbatim.functions.recode import child_flag, first_true, recode_map
from verbatim.functions.zipcodes import normalize_zip, zip_text
from verbatim.operators.attributes import decode_labelled
from verbatim.operators.decode import decode_values, labels_table
from verbatim.operators.fill import fill_forward
from verbatim.operators.lookup import gazetteer_states, lookup_state
from verbatim.operators.reshape import unpivot_responses
from verbatim.plans.panels import PanelConfig


def _ingest_labels(labels: Mapping | DataFrame | None, cfg: PanelConfig):
    """Labels by ingest column name; a table stays a table."""
    if labels is None:
        return {}
    if isinstance(labels, DataFrame):
        name = F.regexp_replace("variable", "[^0-9A-Za-z_]", "_")
        name = F.when(name == cfg.poverty_col, "below_1_5x_fpl").otherwise(name)
        return labels_table(labels, panel=cfg.name).withColumn("variable", name)
    out = {dotted_to_snake(k): v for k, v in labels.items()}
    if cfg.poverty_col in out:
        out["below_1_5x_fpl"] = out.pop(cfg.poverty_col)
    return out


def derive_demographics(master: DataFrame, cfg: PanelConfig, gazetteer: DataFrame | None,
                        parity: bool = False) -> DataFrame:
    """zip text, State lookup, child flag / provider type, language label."""
    z = zip_text(master, cfg.zip_col)
    df = master.withColumn("zip", z if parity else normalize_zip(z))
    if gazetteer is not None:
        df = lookup_state(df, gazetteer_states(gazetteer, dedupe=not parity), "zip",
                          gazetteer=gazetteer)
    else:
        df = df.withColumn("State", F.lit(None).cast("string"))
    if cfg.child_count_col:
        df = df.withColumn("child_0_3", child_flag(F.col(f"`{cfg.child_count_col}`")))
    if cfg.provider_rules:
        rules = [(label, [F.col(f"`{cfg.flag_prefix}{k}`") for k in ks])
                 for label, ks in cfg.provider_rules]
        df = df.withColumn("provider_type", first_true(rules))
    df = df.withColumn("Language", recode_map(F.col(f"`{cfg.language_col}`"), cfg.language_labels))
    if cfg.poverty_col in df.columns:
        df = df.withColumnRenamed(cfg.poverty_col, "below_1_5x_fpl")
    else:  # only with allow_missing
        df = df.withColumn("below_1_5x_fpl", F.lit(None).cast("string"))
    return df


#: Added by ``with_order``: the wave's place in the fold and the row's in its wave.
WAVE, ROW = "__wave", "__row"


def with_order(waves: Sequence[DataFrame], cfg: PanelConfig) -> list[DataFrame]:
    """Numbers the waves' rows, so that rows of one week keep the order wave, row.

    A natural join keeps the earlier waves' rows first; within one file the row number is
    its place in the read (file splits in order), stable for the same files.  Both columns
    would be keys of a natural join, so this is for waves that are stacked (disjoint)."""
    if cfg.tiebreak:
        return list(waves)
    return [w.withColumns({WAVE: F.lit(i), ROW: F.monotonically_increasing_id()})
            for i, w in enumerate(waves)]


def missing_columns(master: DataFrame, cfg: PanelConfig) -> list[str]:
    """Configured columns that the folded waves lack."""
    wanted = [*cfg.question_columns, cfg.poverty_col]
    return [c for c in wanted if c not in master.columns]


def build_response_table(master: DataFrame, cfg: PanelConfig,
                         gazetteer: DataFrame | None = None,
                         value_labels: Mapping | DataFrame | None = None,
                         parity: bool = False, relookup: bool = False,
                         split_hot_keys: bool = True,
                         languages: tuple[str, ...] | None = None,
                         allow_missing: bool = False) -> DataFrame:
    """Long table ``id, week, demographics..., question, response``.

    A configured question or poverty column that the waves lack is an error; with
    ``allow_missing`` such questions have no rows and poverty is NULL (``missing_columns``
    tells which).

    ``value_labels`` is a codebook; columns that it doesn't name are decoded by the value labels
    in their own metadata (``operators.attributes``), if they have any.

    ``languages`` (F2, used by earlier versions) keeps only rows whose language code is
    listed; by default every language is kept.
    """
    lacking = missing_columns(master, cfg)
    if lacking and not allow_missing:
        raise ValueError(f"the waves lack configured columns: {', '.join(lacking)}")
    langs = languages if languages is not None else cfg.languages
    if langs:
        master = master.where(F.col(f"`{cfg.language_col}`").isin(list(langs)))
    df = derive_demographics(master, cfg, None if relookup else gazetteer, parity)
    if relookup:
        df = df.withColumn("State", F.lit(None).cast("string"))
    qcols = {c: code for c, code in cfg.question_columns.items() if c in df.columns}
    tie = [cfg.tiebreak] if cfg.tiebreak else [c for c in (WAVE, ROW) if c in df.columns]
    keep = [cfg.id_col, cfg.week_col, cfg.gate_col, *tie, *qcols, *cfg.demographics]
    df = df.select([F.col(f"`{c}`") for c in dict.fromkeys(keep)])
    df = df.where(F.col(f"`{cfg.gate_col}`") == 1)
    df = decode_values(df, _ingest_labels(value_labels, cfg), exclude=[cfg.id_col])
    df = decode_labelled(df, exclude=[cfg.id_col])  # columns that no codebook names but the schema labels
    carried = [c for c in cfg.carried if not (relookup and c == "State")]
    df = fill_forward(df, cfg.id_col, cfg.week_col, carried, tiebreak=tie or None,
                      split_hot_keys=split_hot_keys)
    if relookup and gazetteer is not None:
        df = lookup_state(df.drop("State"), gazetteer_states(gazetteer, dedupe=not parity), "zip",
                          gazetteer=gazetteer)
    ids = [cfg.id_col, cfg.week_col, *cfg.demographics]
    return unpivot_responses(df.drop(cfg.gate_col), ids, qcols, "question", "response")
