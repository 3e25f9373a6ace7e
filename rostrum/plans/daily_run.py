"""One full run: intake, repair of open rows, scoring, sync state and marts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from rostrum.operators import ingest, marts, members, queue
from rostrum.operators.common import as_time
from rostrum.session import materialize


class Store(NamedTuple):
    speeches: DataFrame
    analysis: DataFrame
    members: DataFrame


class Run(NamedTuple):
    store: Store
    inserted: DataFrame
    marts: marts.Marts


def collect(store: Store, candidates: DataFrame, fetched: DataFrame, as_of: str, now: str) -> tuple[Store, DataFrame]:
    """Refresh incomplete texts, take in new candidates, settle who is active."""
    refreshed = ingest.refresh_text(store.speeches, fetched, as_of)
    selected = materialize(ingest.select_new(candidates, refreshed), "selected")
    intake = ingest.enter_selected(selected, refreshed, store.members, as_time(now))
    people = members.activity_status(intake.members, as_of, now=as_time(now))
    return Store(intake.speeches, store.analysis, people), intake.inserted


def analyze(store: Store, scorer: queue.Scorer, as_of: str, now: str, partitions: int | None = None) -> Store:
    """Revive, skip, score the whole queue once and write the results.

    Revival comes before skipping, so that recovered texts are scored in the same run. The
    responses are written before use: a lost executor must not repeat the calls of others.
    """
    revived = queue.revive_skipped(store.analysis, store.speeches)
    ready = materialize(queue.mark_skipped(store.speeches, revived), "queue-state")
    due = queue.pending_queue(store.speeches, ready, store.members)
    responses = materialize(queue.score_batch(due, scorer, partitions), "responses")
    analysis, speeches = queue.apply_scores(store.speeches, ready, responses, as_time(now))
    stances = members.weighted_stance(speeches, analysis, as_of)
    return Store(speeches, analysis, members.apply_stances(store.members, stances))


def build_marts(store: Store, as_of: str, now: str) -> marts.Marts:
    """Events once, written; the daily and plot marts are derived from the written table."""
    events = materialize(marts.events_mart(store.speeches, store.analysis, store.members, as_time(now)), "events")
    daily = materialize(marts.daily_mart(events, as_of, updated_at=as_time(now)), "daily")
    return marts.Marts(events, daily, marts.plot_mart(daily, events))


def run(
    store: Store, candidates: DataFrame, fetched: DataFrame, scorer: queue.Scorer, as_of: str, now: str,
    partitions: int | None = None,
) -> Run:
    """The periodic run. Tables are written between the steps, so each step has a short
    plan and survives the loss of executors on its own."""
    collected, inserted = collect(store, candidates, fetched, as_of, now)
    stored = Store(
        materialize(collected.speeches, "speeches"), collected.analysis, materialize(collected.members, "members")
    )
    scored = analyze(stored, scorer, as_of, now, partitions)
    final = Store(*[materialize(df, name) for df, name in zip(scored, ("speeches", "analysis", "members"))])
    return Run(final, inserted, build_marts(final, as_of, now))
