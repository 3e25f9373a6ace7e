"""People: D2-D4, D10, D13, D15, A5, A6, A8, A15, J8-J11, J15, W10."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum import schemas
from rostrum.functions import grams, people, scoring
from rostrum.operators.common import as_date, left_join_spread, settle_ids, split_rows
from rostrum.session import materialize

SEARCH_WINDOW = 1000
GRAM = 8
#: Letters of a name's beginning that its index rows are keyed by.
HEAD = 4


def get_or_create_members(members: DataFrame, seen: DataFrame, now: Column) -> DataFrame:
    """Members plus one row for each new (bank_code, name) in `seen`.

    Blank names make no member. A role in `seen` replaces the old one; status is left to
    the activity rule. New ids hash bank and name, so a rerun gives the same ids.
    """
    has_role = "role" in seen.columns
    role = F.col("role") if has_role else F.lit(None).cast("string")
    wanted = (
        seen.where(F.coalesce(F.col("name"), F.lit("")) != "")
        .groupBy("bank_code", "name").agg(F.max(role).alias("_role"))
    )
    old = schemas.conform(members, schemas.MEMBERS)
    joined = old.withColumn("_old", F.lit(True)).join(wanted, ["bank_code", "name"], "full_outer")
    is_new = F.col("_old").isNull()
    role_changed = F.col("_role").isNotNull() & ~F.col("_role").eqNullSafe(F.col("role"))
    hashed = joined.select(is_new.alias("_new"), *[
        {
            "id": F.coalesce("id", F.xxhash64("bank_code", "name")),
            "role": F.coalesce("_role", "role"),
            "status": F.when(is_new, "active").otherwise(F.col("status")),
            "last_updated": F.when(is_new | role_changed, now).otherwise(F.col("last_updated")),
        }.get(c, F.col(c)).alias(c)
        for c in old.columns
    ])
    return settle_ids(hashed, ["bank_code", "name"])


def apply_roster(members: DataFrame, roster: DataFrame, as_of: str, now: Column) -> DataFrame:
    """An official list (bank_code, name, role, ...) verifies and activates its
    people; active people of a listed bank who are not on it retire. A bank without a list
    is untouched."""
    verified = roster.dropDuplicates(["bank_code", "name"])
    extra = [c for c in ("role", "term_start", "term_end") if c in roster.columns]
    listed = verified.select(
        "bank_code", "name", F.lit(True).alias("_listed"), *[F.col(c).alias(f"_new_{c}") for c in extra]
    )
    banks = verified.select("bank_code").distinct().withColumn("_has_list", F.lit(True))
    old = schemas.conform(members, schemas.MEMBERS)
    joined = old.join(listed, ["bank_code", "name"], "full_outer").join(banks, "bank_code", "left")
    on_list = F.col("_listed").isNotNull()
    retire = F.col("_has_list").isNotNull() & ~on_list & (F.col("status") == "active")
    values = {
        "id": F.coalesce("id", F.xxhash64("bank_code", "name")),
        "status": F.when(on_list, "active").when(retire, "retired").otherwise(F.col("status")),
        "term_end": F.when(retire, F.coalesce("term_end", as_date(as_of))).otherwise(F.col("term_end")),
        "last_verified_at": F.when(on_list, as_date(as_of)).otherwise(F.col("last_verified_at")),
        "last_updated": F.when(on_list | retire, now).otherwise(F.col("last_updated")),
    }
    for c in extra:
        values[c] = F.when(on_list, F.coalesce(f"_new_{c}", c)).otherwise(values.get(c, F.col(c)))
    is_new = F.col("id").isNull()
    hashed = joined.select(is_new.alias("_new"), *[values.get(c, F.col(c)).alias(c) for c in old.columns])
    return settle_ids(hashed, ["bank_code", "name"])


def not_in_roster(members: DataFrame, roster: DataFrame) -> DataFrame:
    """Active members of a bank with a list who are not on it."""
    listed_banks = roster.select("bank_code").distinct()
    return (
        members.where(F.col("status") == "active")
        .join(listed_banks, "bank_code", "left_semi")
        .join(roster.select("bank_code", "name"), ["bank_code", "name"], "left_anti")
    )


def activity_status(members: DataFrame, as_of: str, days: int = 365, now: Column | None = None) -> DataFrame:
    """Silent for more than `days` -> retired; spoke since -> active again. A member
    without a speech date is untouched. One pass, no shuffle."""
    cutoff = F.date_sub(as_date(as_of), days)
    retire = F.coalesce((F.col("last_speech_date") < cutoff) & (F.col("status") == "active"), F.lit(False))
    revive = F.coalesce((F.col("last_speech_date") >= cutoff) & (F.col("status") == "retired"), F.lit(False))
    values = {
        "status": F.when(retire, "retired").when(revive, "active").otherwise(F.col("status")),
        "term_end": F.when(retire, F.coalesce("term_end", "last_speech_date")).when(revive, F.lit(None).cast("date"))
        .otherwise(F.col("term_end")),
    }
    if now is not None:
        values["last_updated"] = F.when(retire | revive, now).otherwise(F.col("last_updated"))
    return members.select(*[values.get(c, F.col(c)).alias(c) for c in members.columns])


def activity_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many members retired and how many came back."""
    joined = before.select("id", F.col("status").alias("old")).join(
        after.select("id", F.col("status").alias("new")), "id"
    )
    return joined.agg(
        F.count_if((F.col("old") == "active") & (F.col("new") == "retired")).alias("retired"),
        F.count_if((F.col("old") == "retired") & (F.col("new") == "active")).alias("reactivated"),
    )


def member_status_counts(members: DataFrame) -> DataFrame:
    """A6."""
    return members.groupBy("bank_code", "status").agg(F.count(F.lit(1)).alias("n"))


def member_span(speeches: DataFrame) -> DataFrame:
    """A5: first and last speech date per speaker."""
    return (
        speeches.where(F.col("speaker_id").isNotNull()).groupBy("speaker_id")
        .agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    )


def latest_title(speeches: DataFrame) -> DataFrame:
    """Title of the latest speech per speaker; of one day the highest id."""
    return (
        speeches.where(F.col("speaker_id").isNotNull()).groupBy("speaker_id")
        .agg(F.max_by("title", F.struct("date", "id")).alias("title"))
    )


def fill_member_attrs(members: DataFrame, speeches: DataFrame) -> DataFrame:
    """Term start, last speech date and, where missing, the role.

    Span and latest title come from one aggregate over the speeches.
    """
    facts = (
        speeches.where(F.col("speaker_id").isNotNull()).groupBy(F.col("speaker_id").alias("id"))
        .agg(
            F.min("date").alias("_first"), F.max("date").alias("_last"),
            F.max_by("title", F.struct("date", "id")).alias("_title"),
        )
    )
    no_role = F.coalesce(F.col("role"), F.lit("")) == ""
    values = {
        "term_start": F.coalesce("term_start", "_first"),
        "last_speech_date": F.coalesce("_last", "last_speech_date"),
        "role": F.when(no_role, F.coalesce(people.role_from_title(F.col("_title")), F.col("role")))
        .otherwise(F.col("role")),
    }
    return members.join(facts, "id", "left").select(*[values.get(c, F.col(c)).alias(c) for c in members.columns])


def weighted_stance(speeches: DataFrame, analysis: DataFrame, as_of: str) -> DataFrame:
    """Age-weighted mean score per speaker over every non-null score.

    One join on the unique speech id and one partially aggregated sum.
    """
    scores = analysis.where(F.col("stance_score").isNotNull()).select(F.col("speech_id").alias("id"), "stance_score")
    spoken = speeches.where(F.col("speaker_id").isNotNull() & F.col("date").isNotNull()).select(
        "id", "speaker_id", "date"
    )
    weight = scoring.age_weight(F.col("date"), as_date(as_of))
    return (
        spoken.join(scores, "id")
        .groupBy("speaker_id")
        .agg((F.sum(F.col("stance_score") * weight) / F.sum(weight)).alias("avg_stance_score"))
    )


def apply_stances(members: DataFrame, stances: DataFrame) -> DataFrame:
    """A8 written to the member rows, which then sync again."""
    new = stances.select(F.col("speaker_id").alias("id"), F.col("avg_stance_score").alias("_avg"))
    hit = F.col("_avg").isNotNull()
    values = {
        "avg_stance_score": F.coalesce("_avg", "avg_stance_score"),
        "synced_at": F.when(~hit, F.col("synced_at")),
    }
    return members.join(new, "id", "left").select(*[values.get(c, F.col(c)).alias(c) for c in members.columns])


def orphan_speakers(speeches: DataFrame, members: DataFrame) -> DataFrame:
    """Speeches whose speaker id is no member."""
    return speeches.where(F.col("speaker_id").isNotNull()).join(
        members.select(F.col("id").alias("speaker_id")), "speaker_id", "left_anti"
    )


def merge_map(members: DataFrame) -> DataFrame:
    """(old_id, new_id, name). `new_id` is null for a name that is noise, the
    smallest id of the same (bank, normalized name) otherwise."""
    named = members.select(
        F.col("id").alias("old_id"), "bank_code",
        F.when(~people.is_noise_name(F.col("name")), people.normalize_person(F.col("name"), F.col("bank_code")))
        .alias("name"),
    )
    winners = (
        named.where(F.col("name").isNotNull()).groupBy("bank_code", "name").agg(F.min("old_id").alias("new_id"))
    )
    # Names that are noise are null and have no winner; they pass by the join.
    noise = named.where(F.col("name").isNull()).withColumn("new_id", F.lit(None).cast(named.schema["old_id"].dataType))
    found = named.where(F.col("name").isNotNull()).join(winners, ["bank_code", "name"], "left")
    columns = ("old_id", "new_id", "bank_code", "name")
    return found.select(*columns).unionByName(noise.select(*columns))


def remap_speakers(speeches: DataFrame, id_map: DataFrame) -> DataFrame:
    """Speaker ids through a map; ids that are not in it stay, ids mapped to null go."""
    m = id_map.select(F.col("old_id").alias("speaker_id"), F.col("new_id").alias("_new"), F.lit(True).alias("_hit"))
    return left_join_spread(speeches, m, "speaker_id", "id").select(*[
        F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(c)).alias(c) if c == "speaker_id" else F.col(c)
        for c in speeches.columns
    ])


def merge_members(members: DataFrame, speeches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, speeches) with one member per person and no noise names."""
    id_map = merge_map(members)
    winners = id_map.where(F.col("old_id") == F.col("new_id")).select(
        F.col("old_id").alias("id"), F.col("name").alias("_name")
    )
    kept = members.join(winners, "id").select(*[
        F.col("_name").alias(c) if c == "name" else F.col(c) for c in members.columns
    ])
    return kept, remap_speakers(speeches, id_map)


def _best_first() -> Column:
    """Active members first, then the latest speech, then the name."""
    return F.struct(
        (F.coalesce(F.col("status"), F.lit("")) != "active"),
        -F.coalesce(F.datediff("last_speech_date", F.lit("0001-01-01").cast("date")), F.lit(-1)),
        F.col("name"),
    )


def name_index(members: DataFrame, head: int = HEAD) -> DataFrame:
    """The word-start index of a roster: (bank_code, kind, key, low, name, order).

    A name has a row per word start behind the first ('tail', what follows there), one per length up to `head` of its
    beginning ('start'), and none per further letter: rows grow with the words of names, not with their letters.
    """
    low = F.lower("name")
    parts = F.split(low, " ")
    starts = F.transform(F.sequence(F.lit(1), F.least(F.length(low), F.lit(head))), lambda n: F.struct(
        F.lit("start").alias("kind"), F.substring(F.lower("name"), F.lit(1), n).alias("key")))
    tails = F.transform(
        F.when(F.size(parts) > 1, F.sequence(F.lit(2), F.size(parts))).otherwise(F.array().cast("array<int>")),
        lambda n: F.struct(F.lit("tail").alias("kind"), F.array_join(F.slice(parts, n, F.size(parts)), " ").alias("key")))
    return members.where(F.length("name") > 0).select(
        "bank_code", F.inline(F.array_distinct(F.concat(starts, tails))), low.alias("low"), "name", _best_first().alias("order")
    ).select("bank_code", "kind", "key", "low", "name", "order")


def lastname_lookup(names: DataFrame, members: DataFrame, head: int = HEAD) -> DataFrame:
    """(bank_code, last_name) -> full name, the input where nobody matches.

    `name LIKE '% x' OR name LIKE 'x%'` holds exactly if x is the tail of a name behind a space or its beginning. A
    tail and a beginning of up to `head` letters meet in an equi join with the best member of each key, chosen by a
    partial aggregate. A longer beginning is a range of sorted names: it is joined within the bucket of
    its first `head` letters, the rest being a residual condition.
    """
    asked = names.select("bank_code", F.lower("last_name").alias("x")).where(F.length("x") > 0).distinct()
    index = name_index(members, head)
    best = index.groupBy("bank_code", "kind", "key").agg(F.min(F.struct("order", "name")).alias("b"))
    exact = asked.join(best.withColumnRenamed("key", "x"), ["bank_code", "x"]).select("bank_code", "x", "b")
    long = asked.where(F.length("x") > head).withColumn("key", F.substring("x", 1, head))
    heads = index.where((F.col("kind") == "start") & (F.length("key") == head)).drop("kind")
    ranged = long.join(heads, ["bank_code", "key"]).where(F.startswith(F.col("low"), F.col("x"))).select(
        "bank_code", "x", F.struct("order", "name").alias("b"))
    found = exact.unionByName(ranged).groupBy("bank_code", "x").agg(F.min("b").alias("b")).select(
        "bank_code", "x", F.col("b.name").alias("found"))
    return (
        names.withColumn("x", F.lower("last_name")).join(found, ["bank_code", "x"], "left")
        .withColumn("speaker", F.coalesce("found", "last_name")).drop("x", "found")
    )


def _name_grams(sizes: list[int]):
    """(bank_code, low, salt) -> a row per gram of each name, of GRAM letters or of the whole shorter name."""
    def run(batches):
        for batch in batches:
            for part in grams.slices(batch):
                low = part.column(1).to_pylist()
                size = np.minimum([len(t) for t in low], GRAM)
                rows, found = [], []
                for n, row, h in grams.hashes(low, np.asarray(part.column(2)), sizes):
                    own = size[row] == n
                    rows.append(row[own])
                    found.append(h[own])
                pair = np.unique(np.stack([np.concatenate(rows), np.concatenate(found).view(np.int64)]), axis=1)
                at = pa.array(pair[0])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(pair[1])], names=["bank_code", "low", "gram"])

    return run


def _shared_grams(sizes: list[int], bitmap: np.ndarray, bits: int, counted: bool):
    """Grams of texts (area, salt, ...) that `bitmap` may hold: (gram, n) of a slice of texts if `counted`, else the
    further columns of the text and the gram, once per text."""
    def run(batches):
        for batch in batches:
            for part in grams.slices(batch):
                rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for _, row, h in grams.hashes(part.column(0).to_pylist(), np.asarray(part.column(1)), sizes):
                    index = grams.known(h, bitmap, bits)
                    rows.append(row[index])
                    found.append(h[index].view(np.int64))
                pair = np.unique(np.stack([np.concatenate(rows), np.concatenate(found)]), axis=1)
                if counted:
                    gram, n = np.unique(pair[1], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], names=["gram", "n"])
                else:
                    at = pa.array(pair[0])
                    yield pa.RecordBatch.from_arrays(
                        [*[c.take(at) for c in part.columns[2:]], pa.array(pair[1])], names=[*part.schema.names[2:], "gram"])

    return run


def _slots(bits: int):
    def run(batches):
        for batch in batches:
            found = np.asarray(batch.column(0)).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(grams.slots(found, bits)))], names=["slot"])

    return run


def _bitmap(found: DataFrame) -> tuple[np.ndarray, int]:
    """The grams of `found` (gram) as a bitmap and the power of two of its length: some 64 bits for each, at most 16 MB
    however many there are. With more of them more other grams pass, which then meet nothing in a join."""
    n = found.count()
    bits = min(27, max(16, (64 * n).bit_length()))
    # Numbers of Spark's bitmaps begin with 1.
    slot = F.col("slot") + 1
    rows = found.mapInArrow(_slots(bits), "slot long").groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    out = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for r in rows:
        part = np.frombuffer(r["bits"], np.uint8)
        at = (r["bucket"] - 1) * len(part)
        out[at:at + len(part)] = part
    return out, bits


def name_in_text(speeches: DataFrame, roster: DataFrame) -> DataFrame:
    """(id, speaker): the first name of a bank's list that occurs, in any case, in
    the title or the first 1,000 characters of the text.

    `roster` has (bank_code, name, position). One plan for rosters of any size: the grams that texts share with any
    name are counted, each name is keyed by its rarest one, and the name is looked for only in the texts that have
    it. A name with a gram that no text has meets nothing, and a beginning that many names share ("governor") is
    nobody's key unless nothing rarer is there.

    A text has a thousand grams of each length, so none leaves its task unless a bitmap of the names' grams may hold it:
    counts are summed in the task, and keys are those of its own names, apart from a few that the join drops.
    """
    area = speeches.select(
        "id", "bank_code",
        F.lower(F.concat_ws(" ", "title", F.substring("full_text", 1, SEARCH_WINDOW))).alias("area"),
    ).where(F.col("id").isNotNull() & F.col("bank_code").isNotNull())
    salt = F.xxhash64("bank_code").alias("salt")
    # A null or empty name is no name. Of equal ones the first is looked for.
    low = F.lower("name")
    names = materialize(roster.where((F.length(low) > 0) & F.col("bank_code").isNotNull()).groupBy("bank_code", low.alias("low")).agg(
        F.min(F.struct("position", "name")).alias("first")), "name-list")
    # At most GRAM different key lengths exist; only those are cut from the texts.
    sizes = sorted(r[0] for r in names.select(F.least(F.length("low"), F.lit(GRAM))).distinct().collect())
    if not sizes:
        return area.where(F.lit(False)).select("id", F.lit(None).cast("string").alias("speaker"))
    texts = area.select("area", salt, "id", "bank_code")
    kinds = {f.name: f.dataType.simpleString() for f in names.schema.fields + area.schema.fields}
    named = materialize(names.select("bank_code", "low", salt).mapInArrow(
        _name_grams(sizes), f"bank_code {kinds['bank_code']}, low string, gram long"), "name-grams")
    counts = texts.select("area", "salt").mapInArrow(
        _shared_grams(sizes, *_bitmap(named.select("gram").distinct()), counted=True), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    keyed = named.join(counts, "gram", "left").groupBy("bank_code", "low").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("k")).where(F.col("k.n") > 0).select(
        "bank_code", "low", F.col("k.gram").alias("gram"))
    keyed = materialize(keyed.join(names, ["bank_code", "low"]), "name-keys")
    hits = texts.mapInArrow(
        _shared_grams(sizes, *_bitmap(keyed.select("gram").distinct()), counted=False),
        f"id {kinds['id']}, bank_code {kinds['bank_code']}, gram long").join(keyed, ["bank_code", "gram"]).drop("gram")
    return (
        hits.join(area, ["id", "bank_code"])
        .where(F.contains(F.col("area"), F.col("low")))
        .groupBy("id").agg(F.min("first").alias("first")).select("id", F.col("first.name").alias("speaker"))
    )


def repair_speakers(
    speeches: DataFrame, members: DataFrame, roster: DataFrame, now: Column, byline_banks: tuple[str, ...] = ("RBA",)
) -> tuple[DataFrame, DataFrame]:
    """(speeches, members) with missing speakers filled from a listed name in the
    text, else from the opening lines; speakers are created as needed."""
    open_rows, rest = split_rows(speeches, F.col("speaker_id").isNull() & F.col("full_text").isNotNull())
    listed = name_in_text(open_rows, roster).withColumnRenamed("speaker", "_listed")
    from_lines = F.when(
        F.col("bank_code").isin(*byline_banks), people.speaker_from_lines(F.col("full_text"), "byline")
    )
    from_lines = F.coalesce(from_lines, people.speaker_from_lines(F.col("full_text"), "any"))
    found = (
        open_rows.join(listed, "id", "left")
        .select("id", "bank_code", F.coalesce("_listed", from_lines).alias("_name"))
        .where(F.col("_name").isNotNull())
    )
    all_members = get_or_create_members(members, found.select("bank_code", F.col("_name").alias("name")), now)
    ids = all_members.select("bank_code", F.col("name").alias("_name"), F.col("id").alias("_speaker_id"))
    fills = found.join(ids, ["bank_code", "_name"]).select("id", "_speaker_id")
    hit = F.col("_speaker_id").isNotNull()
    out = open_rows.join(fills, "id", "left").select(*[
        {
            "speaker_id": F.col("_speaker_id"),
            "synced_at": F.when(~hit, F.col("synced_at")),
        }.get(c, F.col(c)).alias(c)
        for c in speeches.columns
    ])
    return out.unionByName(rest), all_members
