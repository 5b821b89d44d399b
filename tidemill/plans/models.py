"""Summaries and labels by a model as single plans: prompts, calls in batches, answers read and joined back.

A client takes a prompt and returns the response's text.  make builds one in each worker.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext
from ..operators import label, summarize
from ..operators.throttle import KeyPool
from ..rules import RuleSet
from ..sources import tables
from .ledger import Ledger, Pace, call_id

Client = Callable[[str], str]


def keyed(client: Callable[[str, str], str], pool: KeyPool) -> Client:
    """A client of (key, prompt) that takes its keys from a pool; after a failure the next key has its turn."""

    def call(prompt: str) -> str:
        key = pool.acquire()
        try:
            return client(key, prompt)
        except Exception:
            pool.rotate()
            raise

    return call


def prompted(client: Client, template: str = "{entries}", headings: Sequence[str] = (), placeholder: str | None = None) -> Callable[[Sequence[str]], list[str | None]]:
    """Posts to summaries through one prompt: entries id1 to idN as JSON in place of {entries}.

    The last answer to an id counts, unknown ids are ignored, and a post without an answer gets null.
    Where a response holds no answers, summaries are rebuilt from its headings, else all get placeholder."""

    def call(posts: Sequence[str]) -> list[str | None]:
        entries = json.dumps([{"id": f"id{i}", "text": x} for i, x in enumerate(posts, 1)], ensure_ascii=False)
        response = client(template.replace("{entries}", entries))
        said = dict(jsontext.parse_response(response, jsontext.part_of(response)))
        if said:
            return [said.get(f"id{i}") for i in range(1, len(posts) + 1)]
        found = jsontext.rebuilt(response, headings)[: len(posts)] if headings else []
        return found + [None] * (len(posts) - len(found)) if found else [placeholder] * len(posts)

    return call


def summarise(df: DataFrame, make: Callable[[], Client], template: str = "{entries}", headings: Sequence[str] = (), placeholder: str | None = None, key: str = "post_raw", ledger: Ledger | None = None, wave: int | None = None, **limits) -> DataFrame:
    """df with summary: each distinct post is asked for once, now, and its answer is kept; limits are those
    of map_distinct().  With a ledger the answers are committed there in waves of so many posts (without a number as in Ledger.run_waves()), and posts
    that it has answered aren't asked for again; without one they are in a table of this session."""
    asked = lambda posts: summarize.map_distinct(posts, key, lambda: prompted(make(), template, headings, placeholder), **limits)
    if ledger is None:
        said = tables.staged(asked(df), "summaries")
    else:
        calls = df.select(F.col(key).alias("prompt")).where(F.col("prompt").isNotNull()).distinct()
        row = (call_id(F.col(key)).alias("call_id"), F.col("summary").alias("response"), F.lit(None).cast("int").alias("key_no"), (F.unix_micros(F.current_timestamp()) / 1e6).alias("asked_at"))
        ledger.run_waves(calls, lambda own: asked(own.select(F.col("prompt").alias(key))).select(*row), wave)
        said = ledger.answers(calls).select(F.col("prompt").alias(key), F.col("response").alias("summary"))
    return summarize.join_back(df, said, key)


def label_calls(df: DataFrame, order: list[Column], size: int = 50, key: str = "comment_id", column: str = "comment_raw", template: str = "{summary}\n{comments}") -> DataFrame:
    """ids, prompt of the calls that label df."""
    prompt = F.replace(F.replace(F.lit(template), F.lit("{summary}"), F.col("summary")), F.lit("{comments}"), F.col("comments"))
    return label.label_batches(df, order, size, key, column).select("ids", prompt.alias("prompt"))


def answered(calls: DataFrame, make: Callable[[], Client], attempts: int = summarize.ATTEMPTS, clients: int | None = None) -> DataFrame:
    """ids, response of calls (ids, prompt), asked now and kept for the session; null where every attempt
    failed.  clients bounds how many workers ask at once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        for frame in frames:
            said = [summarize.retried(lambda: client(prompt), attempts) for prompt in frame["prompt"]]  # noqa: B023
            yield pd.DataFrame({"ids": frame["ids"], "response": pd.Series(said, dtype=object)})

    calls = calls.repartition(clients) if clients else calls
    return tables.staged(calls.select("ids", "prompt").mapInPandas(run, "ids array<string>, response string"), "answers")


def label_all(df: DataFrame, rules: RuleSet, make: Callable[[], Client], order: list[Column], size: int = 50, key: str = "comment_id", column: str = "comment_raw", template: str = "{summary}\n{comments}", attempts: int = summarize.ATTEMPTS, clients: int | None = None, ledger: Ledger | None = None, pace: Pace | None = None) -> DataFrame:
    """df with label: batches of a summary's comments go to a model, its valid answers to ids of the
    batch count (of several to one id the last), and rules and the correction follow.

    Calls are made once, now.  With a ledger a run that was stopped goes on where it stopped; with a pace
    too, make takes a key's number and every key keeps its quotas (tokens as a quarter of the prompt's
    characters).  Rows with null ids keep the neutral label, rows with equal ids get the same one."""
    calls = label_calls(df, order, size, key, column, template)
    if ledger is None:
        said = answered(calls, make, attempts, clients)
    elif pace is None:
        said = ledger.run(calls, make, attempts=attempts, clients=clients)
    else:
        said = ledger.run_paced(calls, make, pace, F.floor(F.length("prompt") / 4))
    answers = jsontext.label_map(jsontext.json_part(F.col("response")))
    pairs = said.select("ids", F.posexplode(F.map_entries(answers)).alias("at", "x")).where(F.array_contains("ids", F.col("x.key")))
    model = pairs.groupBy(F.col("x.key").cast(df.schema[key].dataType).alias(key)).agg(F.max_by("x.value", "at").alias("label"))
    return label.label_comments(df, rules, model, key, column)
