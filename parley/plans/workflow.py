"""The whole workflow: profile, clean, split, prepare for training."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.constants import SEED, TEST_FRACTION, VALIDATION_FRACTION
from parley.functions.messages import ChatTemplate, content_key, is_chat_pair, to_messages
from parley.functions.tokens import TokenizerFactory
from parley.operators.clean import (
    clean_messages,
    kept_columns,
    message_counts,
    message_rows,
    normalize_rows,
    observe_rows,
    remove_duplicates,
    remove_null,
)
from parley.operators.profile import (
    dataset_stats,
    length_counts,
    length_histogram,
    length_stats,
    message_lengths,
    preview,
)
from parley.operators.sft import to_training_text, tokenize_sft, training_plan
from parley.operators.splits import head_per_split, pick_example, split_dataset
from parley.plans.stages import Stages
from parley.session import materialize
from parley.sources.datasets import list_splits, read_dataset, read_report, with_split, write_dataset, write_report


@dataclass
class Workflow:
    """Results by stage; None where a stage was skipped."""

    stats: DataFrame | None = None
    preview: DataFrame | None = None
    example: DataFrame | None = None
    token_stats: DataFrame | None = None
    length_counts: DataFrame | None = None
    length_histogram: DataFrame | None = None
    counts: dict[str, int] | None = None
    stage_counts: DataFrame | None = None
    dataset: DataFrame | None = None
    split_sizes: DataFrame | None = None
    training_text: DataFrame | None = None
    training_tokens: DataFrame | None = None
    training_plan: DataFrame | None = None


def clean(
    df: DataFrame, order_by: Sequence[str], keep: Sequence[str] = (), keep_other_fields: bool = False
) -> tuple[DataFrame, dict]:
    """Null filter, normalisation, deduplication, conversion: one plan, one shuffle.

    The messages are built once, before deduplication, and take the place of
    the raw columns: they give the key, and nothing else crosses the shuffle.
    Also returns the observations that count each stage's rows as they pass.
    """
    seen = {}
    df, seen["raw"] = observe_rows(with_split(df), "raw")
    df, seen["no_null"] = observe_rows(remove_null(df), "no_null")
    df, seen["normalized"] = observe_rows(normalize_rows(df), "normalized")
    kept = kept_columns(df, [*keep, *order_by], keep_other_fields)
    df = df.select(*kept, to_messages(df).alias("messages"))
    messages = F.col("messages")
    df, seen["deduplicated"] = observe_rows(
        remove_duplicates(df, order_by, key=content_key(messages)), "deduplicated"
    )
    df, seen["chat"] = observe_rows(df.where(is_chat_pair(messages)), "chat")
    return df, seen


def run_workflow(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    skip_profile: bool = False,
    skip_clean: bool = False,
    skip_training: bool = False,
    keep_other_fields: bool = False,
    test: float = TEST_FRACTION,
    validation: float = VALIDATION_FRACTION,
    seed: int = SEED,
    profile_rows: int | None = None,
    tokenizer: str | TokenizerFactory = "words",
    training_tokenizer: str | TokenizerFactory = "codepoints",
    template: str | ChatTemplate = "chatml",
    max_length: int | None = None,
    path: str | None = None,
    resume: bool = False,
) -> Workflow:
    """Run the stages in their fixed order.

    The raw rows are read, normalised and turned into messages once; that table, written to the shared scratch folder,
    feeds lengths, stage counts and cleaning. The two length columns are written once for all
    statistics of them, and so are the cleaned rows: splitting reads only their
    key from there, and no later stage repeats the cleaning.

    With ``path``, each stage's results are saved below it before the next stage
    starts, so a failing stage stops the rest: reports as one JSON folder each in
    ``reports``, the split rows as ``dataset``, the training tokens as ``training``.
    Without it only the written parts run here; the frames are yet to be read. ``stage_counts``, per split, and their
    totals ``counts`` are exact.

    ``resume`` (with ``path``) keeps the written tables below it as well, in ``stages``, and a manifest of each finished stage in
    ``manifests``. A second run with the same arguments over the same input files skips what is finished, and
    does not read the raw rows again once the messages are there. Frames that are read from no file are all alike to it.
    """
    done = Workflow()
    df = with_split(df)
    arguments = {k: v for k, v in locals().items() if k not in ("df", "done", "path", "resume")}
    if resume and path is None:
        raise ValueError("only a workflow with a path can be resumed")
    stages = Stages(df.sparkSession, path, df.inputFiles(), arguments) if resume else None

    def written(build, name: str) -> DataFrame:
        return stages.table(name, build) if stages else materialize(build(), name)

    def once(name: str, place: str, write) -> None:
        stages.once(name, place, write) if stages else write(place)

    mode = "overwrite" if resume else "errorifexists"  # what a failed run has left of a stage

    def report(name: str, build) -> None:
        """A report, saved if there is a path; of a finished stage the saved one."""
        place = f"{path}/reports/{name}"
        if stages and stages.manifest(name):
            setattr(done, name, read_report(df.sparkSession, place))
            return
        setattr(done, name, build())
        if path is not None:
            once(name, place, lambda to: write_report(getattr(done, name), to, mode))

    if not (skip_profile and skip_clean):
        kept = [*key, *order_by]
        messages = written(lambda: message_rows(df, kept, keep_other_fields), "messages")
    if not skip_profile:
        first = messages if profile_rows is None else head_per_split(messages, profile_rows, order_by)
        lengths = written(lambda: message_lengths(first, tokenizer, template), "lengths")
        report("stats", lambda: dataset_stats(df))
        report("preview", lambda: preview(df, order_by=order_by))
        report("example", lambda: pick_example(df, order_by=order_by))
        report("token_stats", lambda: length_stats(lengths))
        report("length_counts", lambda: length_counts(lengths))
        report("length_histogram", lambda: length_histogram(lengths))
    if not skip_clean:
        report("stage_counts", lambda: materialize(message_counts(messages), "stage-counts"))
        totals = done.stage_counts.groupBy("step", "stage").agg(F.sum("rows").alias("rows")).orderBy("step")
        done.counts = {r["stage"]: r["rows"] for r in totals.collect()}
        cleaned = written(lambda: clean_messages(messages, order_by), "cleaned")
        df = cleaned if stages and stages.manifest("dataset") else split_dataset(cleaned, key, test, validation, seed)
    if path is not None:
        once("dataset", f"{path}/dataset", lambda place: write_dataset(df, place, mode))
        df = read_dataset(df.sparkSession, f"{path}/dataset")
    done.dataset = df
    split_rows = df
    report("split_sizes", lambda: list_splits(split_rows))
    if not skip_training:
        done.training_text = to_training_text(df, template, keep=key)
        done.training_tokens = tokenize_sft(done.training_text, training_tokenizer, max_length, keep=key)
        if path is not None:
            once("training", f"{path}/training", lambda place: done.training_tokens.write.mode(mode).parquet(place))
        report("training_plan", lambda: training_plan(split_rows))
    return done
