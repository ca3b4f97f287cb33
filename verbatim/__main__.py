"""Command line: one panel refresh, end to end.

    python -m verbatim --panel ec --waves data/ec_2020.parquet data/ec_2021.parquet \\
        --gazetteer data/US.txt --value-labels data/value_labels.parquet \\
        --variable-labels data/variable_labels.parquet --catalog data/menu.json --out out/

Writes ``out/responses``, ``out/edges``, ``out/vertices`` (partitioned by panel and
question number), ``out/question_index`` and, with ``--catalog``, ``out/catalog_audit``; each
run replaces its own panel only.  With ``--publish`` the same tables become a new version of the
panel's pages, which takes the old one's place at one moment.
Runs on whatever cluster ``spark-submit`` provides; ``--master`` is for local use.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from verbatim.functions.text import tokens
from verbatim.functions.words import unicode_words
from verbatim.operators.attributes import merged_attributes, question_texts, with_metadata
from verbatim.operators.audit import catalog_audit, question_dimension, question_index
from verbatim.operators.graph import bigram_network
from verbatim.operators.harmonize import fold_waves, stack_waves, waves_disjoint
from verbatim.operators.wavetypes import align_types
from verbatim.plans import panels
from verbatim.plans.publish import Published
from verbatim.plans.reports import attach_questions
from verbatim.plans.response_table import build_response_table, missing_columns, with_order
from verbatim.plans.sinks import panels_of, write_by_panel, write_network, write_responses
from verbatim.session import get_spark, lineage_tables
from verbatim.sources.catalog import read_catalog
from verbatim.sources.codebook import read_value_labels, read_variable_labels
from verbatim.sources.gazetteer import read_gazetteer
from verbatim.sources.menu import menu_questions, read_menu
from verbatim.sources.stopwords import read_stop_words
from verbatim.sources.waves import wave_columns, read_waves

CONFIGS = {
    "ec": lambda cols: panels.EC,
    "cc": lambda cols: panels.CC,
    "ec-first": panels.first_household_config,
    "ec-archived": panels.archived_household_config,
    "cc-archived": panels.archived_provider_config,
}


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="verbatim", description=__doc__.splitlines()[0])
    p.add_argument("--panel", choices=sorted(CONFIGS), required=True)
    p.add_argument("--waves", nargs="+", required=True, help="wave files, oldest first")
    p.add_argument("--format", default="parquet", help="wave file format")
    p.add_argument("--gazetteer", help="header-less tab-separated zip file")
    p.add_argument("--value-labels", help="value_labels(panel, variable, code, label); default: the columns' attributes")
    p.add_argument("--variable-labels", help="variable_labels(panel, variable, position, label); default: the columns' attributes")
    p.add_argument("--catalog", help="menu entries as JSON lines")
    p.add_argument("--menu", help="the nested menu (JSON of the site configuration) in place of --catalog")
    p.add_argument("--out", required=True)
    p.add_argument("--parity", action="store_true", help="reference zip handling exactly")
    p.add_argument("--disjoint-on", default="Week",
                   help="column whose values never repeat across waves (stack instead of join)")
    p.add_argument("--stop-words", help="stop-word table with a column word (Parquet)")
    p.add_argument("--unicode-words", action="store_true",
                   help="words by the Unicode rules: underscores join, scripts without spaces split")
    p.add_argument("--language", nargs="+", help="language codes to keep (default: the panel's)")
    p.add_argument("--relookup", action="store_true",
                   help="look State up from the carried zip instead of carrying both")
    p.add_argument("--allow-missing", action="store_true",
                   help="report configured columns that the waves lack instead of failing")
    p.add_argument("--publish", action="store_true",
                   help="write a new version and switch to it when complete (plans.publish); the old pages stay readable")
    p.add_argument("--master", help="e.g. local[8]; omit under spark-submit")
    return p.parse_args(argv)


def main(argv=None, spark=None) -> None:
    a = parse_args(argv)
    spark = spark or get_spark(a.master)
    with lineage_tables(spark):
        refresh(spark, a)


def refresh(spark, a: argparse.Namespace) -> None:
    waves = read_waves(spark, a.waves, fmt=a.format)
    cfg = CONFIGS[a.panel](wave_columns(spark, a.waves, fmt=a.format))
    frames = align_types(list(waves.values()))
    if waves_disjoint(frames, a.disjoint_on):  # no row can match across waves
        master = with_metadata(stack_waves(with_order(frames, cfg)), merged_attributes(frames))
    else:
        master = fold_waves(frames)
    if a.allow_missing:
        for c in missing_columns(master, cfg):
            print(f"missing column: {c}")
    gaz = read_gazetteer(spark, a.gazetteer) if a.gazetteer else None
    labels = read_value_labels(spark, a.value_labels) if a.value_labels else None
    if a.variable_labels:
        texts = read_variable_labels(spark, a.variable_labels)
    else:  # the columns' own
        texts = {cfg.question_columns[c]: t for c, t in question_texts(master).items() if c in cfg.question_columns} or None

    long = build_response_table(master, cfg, gaz, labels, parity=a.parity, relookup=a.relookup,
                                languages=tuple(a.language) if a.language else None,
                                allow_missing=a.allow_missing)
    questions = question_dimension(spark, cfg.name, list(cfg.question_codes), texts)
    stop = read_stop_words(spark, a.stop_words) if a.stop_words else None
    words = unicode_words if a.unicode_words else tokens
    catalog = read_catalog(spark, a.catalog) if a.catalog else menu_questions(read_menu(spark, a.menu)) if a.menu else None
    catalog = catalog.where(f"panel = '{cfg.name}'") if catalog is not None else None
    if a.publish:
        with Published(spark, a.out).refresh(cfg.name) as new:
            new.write("responses", attach_questions(long, questions))
            net = bigram_network(new.read("responses").select("question", "response"), stop=stop, questions=list(cfg.question_codes), tokenizer=words)
            new.write("edges", attach_questions(net.edges, questions))
            new.write("vertices", attach_questions(net.vertices, questions))
            new.write("question_index", question_index(questions))
            if catalog is not None:
                new.write("catalog_audit", catalog_audit(catalog, questions))
        return
    panels = panels_of(questions)
    write_responses(long, questions, a.out)
    # the network reads the table just written: the waves are folded and filled once
    done = spark.read.parquet(f"{a.out}/responses").where(F.col("panel") == cfg.name)
    net = bigram_network(done.select("question", "response"), stop=stop,
                         questions=list(cfg.question_codes), tokenizer=words)
    write_network(net, questions, a.out)
    write_by_panel(question_index(questions), f"{a.out}/question_index", panels)
    if catalog is not None:
        write_by_panel(catalog_audit(catalog, questions), f"{a.out}/catalog_audit", panels)


if __name__ == "__main__":
    main()
