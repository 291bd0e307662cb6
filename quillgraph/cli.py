"""Command line: generate and evaluate."""

from __future__ import annotations

import argparse
import json
import os
import sys

from .config import ENTITY_STRATEGIES, MODES, PATH_STRATEGIES, ChatConfig, EvaluateConfig, GenerateConfig
from .operators.prompts import STYLES


def positive_ints(value: str) -> tuple[int, ...]:
    try:
        found = tuple(int(x) for x in value.split(",") if x.strip())
    except ValueError:
        raise argparse.ArgumentTypeError(f"not whole numbers: {value}") from None
    if not found or min(found) < 1:
        raise argparse.ArgumentTypeError("numbers must be positive")
    return found


def known_styles(value: str) -> tuple[str, ...]:
    found = tuple(x.strip() for x in value.split(",") if x.strip())
    if not found or not set(found) <= set(STYLES):
        raise argparse.ArgumentTypeError(f"styles are {', '.join(STYLES)}")
    return found


def labelled(value: str) -> tuple[str, str]:
    """label=path, or a path whose file name is the label."""
    label, split, path = value.partition("=")
    if split and not label.strip():
        raise argparse.ArgumentTypeError("the label is empty")
    return (label.strip(), path) if split else (os.path.splitext(os.path.basename(value))[0], value)


#: Option names of users' scripts, with the field of the settings that each one sets.
GENERATE = {
    "max-docs": "max_docs", "max-entities": "max_entities", "min-entity-chars": "min_entity_chars", "max-combos-per-doc": "max_combos",
    "cross-doc-min-shared-entities": "min_shared", "cross-doc-max-shared-entities": "max_shared", "cross-doc-max-pairs": "max_pairs",
    "sog-path-length": "path_length", "sog-max-paths": "max_paths", "sog-max-section-chars": "max_section_chars",
    "sog-candidate-multiplier": "candidate_multiplier", "sog-min-shared-entities": "path_min_shared", "long-context-paths-per-example": "group_size",
    "long-context-max-examples": "group_max_examples", "long-context-max-chars": "group_max_chars", "random-seed": "seed", "max-workers": "workers",
    "max-in-flight": "max_in_flight", "entity-max-tokens": "entity_max_tokens", "relation-max-tokens": "relation_max_tokens",
}
EVALUATE = {"min-overall-score": "min_overall", "min-support": "min_support", "min-mention": "min_mention", "max-unsupported-proper-nouns": "max_unsupported", "max-redundancy-overlap": "max_overlap"}
CHAT = ("provider", "model", "base_url", "api_key", "api_key_env", "timeout", "max_retries")


def _keys(command: argparse.ArgumentParser) -> None:
    command.add_argument("--text-key", default="text")
    command.add_argument("--title-key", default="title", type=lambda v: v or None)
    command.add_argument("--id-key")


def _options(command: argparse.ArgumentParser, names: dict[str, str], kind: type | None, defaults: object) -> None:
    """Each name, and the name of its field, set that field."""
    for name, field in names.items():
        default = getattr(defaults, field)
        command.add_argument(*dict.fromkeys((f"--{name}", f"--{field.replace('_', '-')}")), dest=field, type=kind or type(default), default=default)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quillgraph")
    commands = top.add_subparsers(dest="command", required=True)
    d, c, v = GenerateConfig(), ChatConfig(), EvaluateConfig()
    g = commands.add_parser("generate", help="make tasks from a corpus and have a chat model answer them")
    g.add_argument("--input", required=True)
    g.add_argument("--output", required=True)
    g.add_argument("--entity-cache", required=True)
    g.add_argument("--mode", choices=MODES, default=d.mode)
    _keys(g)
    _options(g, GENERATE, int, d)
    _options(g, {"entity-temperature": "entity_temperature", "relation-temperature": "relation_temperature"}, float, d)
    g.add_argument("--entity-selection-strategy", "--entity-strategy", dest="entity_strategy", choices=ENTITY_STRATEGIES, default=d.entity_strategy)
    g.add_argument("--sog-path-strategy", "--path-strategy", dest="path_strategy", choices=PATH_STRATEGIES, default=d.path_strategy)
    g.add_argument("--combo-sizes", type=positive_ints, default=d.combo_sizes)
    g.add_argument("--generation-styles", "--styles", dest="styles", type=known_styles, default=d.styles)
    g.add_argument("--sample-combos", action="store_true")
    g.add_argument("--cross-doc-sample-pairs", "--sample-pairs", dest="sample_pairs", action="store_true")
    g.add_argument("--include-source-text", action="store_true")
    g.add_argument("--json-mode", action="store_true", help="ask the server for JSON objects")
    g.add_argument("--no-resume", dest="resume", action="store_false")
    g.add_argument("--no-progress", action="store_true", help="without Spark's progress bars")
    g.add_argument("--generator", default="quillgraph")
    g.add_argument("--provider", choices=("local", "openai", "vllm"), default=c.provider)
    g.add_argument("--model", default=c.model)
    for name in ("base-url", "api-key", "api-key-env"):
        g.add_argument(f"--{name}")
    g.add_argument("--timeout", type=float, default=c.timeout)
    g.add_argument("--max-retries", type=int, default=c.max_retries)
    e = commands.add_parser("evaluate", help="score generated rows against their sources")
    e.add_argument("--input", "--sources", dest="sources", required=True)
    e.add_argument("--generated", required=True)
    e.add_argument("--output-dir", default="evaluate")
    e.add_argument("--entity-cache")
    _keys(e)
    _options(e, EVALUATE, None, v)
    f = commands.add_parser("fixture", help="report what a corpus and generated files hold")
    f.add_argument("--fixture", required=True)
    f.add_argument("--entity-cache")
    f.add_argument("--combo-sizes", type=positive_ints, default=d.combo_sizes)
    f.add_argument("--generated", action="append", default=[])
    f.add_argument("--top", type=int, default=50, help="the most documents, entities and pairs to list")
    p = commands.add_parser("compare", help="score several generated files against one corpus")
    p.add_argument("--input", "--sources", dest="sources", required=True)
    p.add_argument("--entity-cache")
    p.add_argument("--generated", action="append", required=True, type=labelled, help="path or label=path")
    return top


def main(argv: list[str] | None = None) -> int:
    args = vars(parser().parse_args(argv))
    from pyspark.sql import SparkSession

    from .plans import pipeline

    builder = SparkSession.builder.appName("quillgraph")
    if args.pop("no_progress", False):
        builder = builder.config("spark.ui.showConsoleProgress", "false")
    spark, command = builder.getOrCreate(), args.pop("command")
    if command == "generate":
        from .sources.chat import HttpChatClient

        chat = ChatConfig(**{k: args.pop(k) for k in CHAT})
        source, output, cache = args.pop("input"), args.pop("output"), args.pop("entity_cache")
        metadata = (("provider", chat.provider), ("model", chat.model), ("generator", args.pop("generator")))
        stats = pipeline.run(spark, GenerateConfig(metadata=metadata, **args), source, cache, output, lambda: HttpChatClient(chat))
        print(json.dumps(stats, indent=2))
        return int(any(n for k, n in stats.items() if k.endswith("_failed")))
    if command == "fixture":
        print(pipeline.fixture_report(spark, args["fixture"], args["entity_cache"], args["combo_sizes"], tuple(args["generated"]), args["top"]), end="")
        return 0
    if command == "compare":
        print(pipeline.comparison_report(spark, args["sources"], dict(args["generated"]), args["entity_cache"]), end="")
        return 0
    paths = [args.pop(k) for k in ("sources", "generated", "output_dir", "entity_cache")]
    summary = pipeline.evaluate_files(spark, *paths, EvaluateConfig(**args))
    print(json.dumps(summary, indent=2))
    return int(summary["failed"] > 0)


if __name__ == "__main__":
    sys.exit(main())
