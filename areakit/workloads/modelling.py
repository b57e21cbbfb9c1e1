"""Registered queries of the room model and of streaming."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areakit import schemas
from areakit.plans import rooms
from areakit.session import scratch
from areakit.sources.tables import read_table
from areakit.streaming import batches, messages, scoring, upkeep
from areakit.workloads import roles
from areakit.workloads.batch import published

# Files of events and files a batch; years in which listings land; buckets of the state.
EVENTS_A_FILE, FILES_A_BATCH = 1_000, 3
LANDINGS = (0, 1998, 2000)
UPKEEP_BUCKETS = 16
MOST_SECONDS = 3_600  # of a bounded run


def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rooms.frequency_index(roles.rooms_rows(spark, sf_dir), rooms.LABEL)


def ml_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes, the one-hot slot that is set, and the price slot of each row."""
    rows = roles.rooms_rows(spark, sf_dir)
    featured = rooms.fit_features(rows).transform(rows)
    slots = vector_to_array(F.col(rooms.FEATURES))
    one_hot = vector_to_array(F.col(rooms.CATEGORY_ONE_HOT))
    return featured.select(
        "p_partkey",
        F.col(rooms.LABEL_INDEX).cast("int").alias("label_index"),
        F.col(rooms.CATEGORY_INDEX).cast("int").alias("category_index"),
        (F.array_position(one_hot, 1.0) - 1).cast("int").alias("hot_slot"),
        F.size(slots).alias("n_features"),
        F.element_at(slots, -1).alias("price"),
    )


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.rooms_rows(spark, sf_dir)
    return rows.withColumn("side", rooms.split_side(F.col("p_partkey")))


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame]:
    rows = train_test_split(spark, sf_dir)
    train, test = (rows.filter(F.col("side") == side) for side in ("train", "test"))
    return rooms.fit_rooms(train), test


def model_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each test part, and whether its predicted label is the one its index stands for."""
    model, test = _fitted(spark, sf_dir)
    named = F.array(*map(F.lit, [*model.stages[0].labels, rooms.UNKNOWN_LABEL]))
    label = F.element_at(named, F.col("prediction").cast("int") + 1)
    return rooms.predict(model, test).select(
        "p_partkey", rooms.CATEGORY, rooms.PRICE, (label == F.col(rooms.PREDICTED)).alias("label_is_named")
    )


def model_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accuracy table's row count, and whether it agrees with the evaluator."""
    model, test = _fitted(spark, sf_dir)
    predictions = rooms.predict(model, test)
    expected = rooms.accuracy(predictions)
    agrees = F.abs(F.col("accuracy") - F.lit(expected)) < 1e-9
    return rooms.accuracy_table(predictions).select("n_rows", agrees.alias("equals_evaluator"))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the saved and reloaded model predicts the same for each test part."""
    model, test = _fitted(spark, sf_dir)
    path = scratch(spark, "rooms-model")
    rooms.save_model(model, path)
    before, after = (
        rooms.predict(m, test).select("p_partkey", F.struct("prediction", rooms.PREDICTED).alias(name))
        for m, name in ((model, "before"), (rooms.load_model(path), "after"))
    )
    same = (F.col("before") == F.col("after")).alias("same_prediction")
    return before.join(after, "p_partkey").select("p_partkey", same)


def model_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, the forest's size, and whether its importances add up to one."""
    model, _ = _fitted(spark, sf_dir)
    total = F.aggregate("importances", F.lit(0.0), lambda total, x: total + x)
    summary = rooms.model_summary(spark, model)
    return summary.withColumn("adds_up", F.abs(total - 1) < 1e-9).drop("importances")


def model_from_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model trained on the flat table that the integration published, per area of its test rows.

    ``n_named`` counts the predictions whose label is the one their index stands for.
    """
    zone, _ = published(spark, sf_dir)
    model, predictions = rooms.train_rooms(read_table(spark, f"{zone}/data"))
    named = F.array(*map(F.lit, [*model.stages[0].labels, rooms.UNKNOWN_LABEL]))
    label = F.element_at(named, F.col("prediction").cast("int") + 1)
    right = F.count_if(label == F.col(rooms.PREDICTED))
    return predictions.groupBy(rooms.CATEGORY).agg(F.count(F.lit(1)).alias("n_rows"), right.alias("n_named"))


def parse_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.accepted(messages.parse_messages(roles.event_messages(spark, sf_dir)))


def _written(spark: SparkSession, rows: DataFrame) -> str:
    path = scratch(spark, "messages")
    rows.write.text(path)
    return path


def stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch query's parse over a stream, appended to Parquet."""
    stream = messages.message_stream(
        spark, "text", _written(spark, roles.event_messages(spark, sf_dir))
    )
    target = scratch(spark, "parsed")
    parsed = messages.accepted(messages.parse_messages(stream))
    messages.run_for(messages.append_to(parsed, f"{target}-log", path=target), MOST_SECONDS)
    return spark.read.schema(parsed.schema).parquet(target)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with its route, from a sink partitioned by route."""
    stream = messages.message_stream(
        spark, "text", _written(spark, roles.event_messages(spark, sf_dir))
    )
    target = scratch(spark, "routed")
    routed = messages.routed(messages.parse_messages(stream))
    messages.run_for(
        messages.append_to(routed, f"{target}-log", path=target, partition_by="route")
    )
    return spark.read.schema(routed.schema).parquet(target).select(*routed.columns)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with one checkpoint, more messages having arrived in between."""
    rows = roles.event_messages(spark, sf_dir)
    clicks = F.col("value").contains(",click")
    path, target = _written(spark, rows.filter(clicks)), scratch(spark, "restarted")

    def run() -> DataFrame:
        parsed = messages.accepted(
            messages.parse_messages(messages.message_stream(spark, "text", path))
        )
        messages.run_for(messages.append_to(parsed, f"{target}-log", path=target))
        return parsed

    run()
    rows.filter(~clicks).write.mode("append").text(path)
    parsed = run()
    return spark.read.schema(parsed.schema).parquet(target)


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected messages in two targets, after the last batch was written twice.

    The first run's commit is taken back, so the second one gets the same batch again, and
    then what has arrived since.
    """
    rows = roles.event_messages(spark, sf_dir)
    clicks = F.col("value").contains(",click")
    path, target = _written(spark, rows.filter(clicks)), scratch(spark, "batches")
    targets = {route: f"{target}/{route}" for route in ("accepted", "rejected")}

    def run() -> None:
        stream = messages.message_stream(spark, "text", path)
        routed = messages.routed(messages.parse_messages(stream))
        messages.run_for(batches.start_batches(routed, f"{target}/log", batches.split_targets(targets)))

    run()
    batches.forget_commit(spark, f"{target}/log", 0)
    run()
    rows.filter(~clicks).write.mode("append").text(path)
    run()
    columns = messages.routed(messages.parse_messages(rows)).columns
    found = [spark.read.parquet(place).withColumn("route", F.lit(route)) for route, place in targets.items()]
    return found[0].unionByName(found[1]).select(*columns)


def stream_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offsets of every batch over two runs of a few files each time, without gap or overlap."""
    events = roles.table(spark, sf_dir, "events").select("event_id", F.floor(F.col("event_id") / EVENTS_A_FILE).alias("part"))
    path, target = scratch(spark, "events"), scratch(spark, "offsets")
    session = batches.many_batches(spark, f"{target}/log")

    def arrive(remainder: int) -> None:
        some = events.filter(F.col("part") % 2 == remainder).select("part", F.col("event_id").cast("string").alias("value"))
        some.repartition("part").write.mode("append").partitionBy("part").text(path)

    for remainder in (0, 1):
        arrive(remainder)
        stream = messages.message_stream(session, "text", path, maxFilesPerTrigger=str(FILES_A_BATCH), recursiveFileLookup="true")
        query = messages.append_to(stream, f"{target}/log", path=f"{target}/out")
        messages.run_for(query, meanwhile=lambda: batches.trim_sink_log(spark, f"{target}/out"))
    log = batches.offset_log(spark, f"{target}/log")
    at = lambda c: F.get_json_object(c, "$.logOffset").cast("long")
    total = session.read.schema("value string").parquet(f"{target}/out").agg(F.count_distinct("value").alias("n_events"), F.count("value").alias("n_rows"))
    found = log.select("batch", at("start_offset").alias("start_offset"), at("end_offset").alias("end_offset"), "committed")
    return found.crossJoin(F.broadcast(total))  # one row


def _upkeep(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Listings that land in three runs: the latest ones, and what each run has read."""
    rows = roles.scoped_listings(spark, sf_dir).drop("province")
    inbox, target = scratch(spark, "landed"), scratch(spark, "latest")
    merge = upkeep.merge_latest(f"{target}/state", rows.schema, ["propertyCode"], ["date", *roles.TIE_BREAKERS], UPKEEP_BUCKETS)

    def write(batch: DataFrame, number: int) -> None:
        merge(batch, number)
        read = batch.agg(F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first"), F.max("date").alias("last"))
        read.write.mode("overwrite").parquet(f"{target}/read/{batches.BATCH}={number}")

    for first, end in zip(LANDINGS, [*LANDINGS[1:], 9999]):
        year = F.year("date")
        rows.filter((year >= first) & (year < end)).write.mode("append").parquet(inbox)
        arriving = spark.readStream.schema(rows.schema).parquet(inbox)
        messages.run_for(batches.start_batches(arriving, f"{target}/log", write))
    return upkeep.read_state(spark, f"{target}/state", rows.schema), spark.read.parquet(f"{target}/read")


def latest_upkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upkeep(spark, sf_dir)[0].select("neighborhood", "propertyCode", *schemas.LISTING_FIELDS)


def latest_upkeep_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each run reads the files that are new, and only those."""
    return _upkeep(spark, sf_dir)[1].select(F.col(batches.BATCH).cast("int").alias("run"), "n_rows", "first", "last")


def stream_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part messages scored as a stream, and whether the batch scores them the same."""
    model, _ = _fitted(spark, sf_dir)
    stream = messages.message_stream(
        spark, "text", _written(spark, roles.part_messages(spark, sf_dir))
    )
    scored = scoring.score_messages(stream, model)
    target = scratch(spark, "scored")
    messages.run_for(messages.append_to(scored, f"{target}-log", path=target))
    streamed = spark.read.schema(scored.schema).parquet(target)
    batch = scoring.score_messages(roles.part_messages(spark, sf_dir), model).distinct()
    keys, values = [messages.CATEGORY, messages.PRICE], ["prediction", "predicted_rooms"]
    expected = batch.select(*keys, F.struct(*values).alias("expected"))
    same = (F.struct(*values) == F.col("expected")).alias("equals_batch")
    return streamed.join(expected, keys).select(*keys, same)


QUERIES = {
    "label_index": label_index,
    "ml_features": ml_features,
    "train_test_split": train_test_split,
    "model_predict": model_predict,
    "model_accuracy": model_accuracy,
    "model_roundtrip": model_roundtrip,
    "model_summary": model_summary,
    "model_from_zone": model_from_zone,
    "parse_messages": parse_messages,
    "stream_parse": stream_parse,
    "stream_rejects": stream_rejects,
    "stream_restart": stream_restart,
    "stream_batches": stream_batches,
    "stream_offsets": stream_offsets,
    "latest_upkeep": latest_upkeep,
    "latest_upkeep_runs": latest_upkeep_runs,
    "stream_predict": stream_predict,
}
