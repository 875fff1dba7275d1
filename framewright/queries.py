"""The registered queries, an operator each, over the fixture tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import kernels, models, paths, tensor
from .operators import batches, monitor, pairing, sequence, sharding, shuffle
from .oracle import SQL
from .streaming import windows as stream

__all__ = ["QUERIES", "SQL"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as frames: a user is a video."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return sequence.with_index(events, ["user_id"], ["ts", "event_id"])


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as short videos; the turn is the frame number."""
    return table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("i"))


def vectors(spark: SparkSession, sf_dir: str, numbered: bool = False) -> DataFrame:
    """Embeddings as images of 8 by 8 pixels of doubles."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    return sharding.with_position(rows, "vec_id") if numbered else rows


def quantised(df: DataFrame) -> DataFrame:
    """Pixels as bytes."""
    return df.withColumn("q", F.transform("x", lambda v: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((v + 1) * 127.5))).cast("int")))


def pixels(df: DataFrame, column: str, digits: int | None = None, keys: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """A row a pixel: keys, p, v."""
    got = df.select(*keys, F.posexplode(column).alias("p", "v")).withColumn("p", F.col("p").cast("long"))
    return got.withColumn("v", F.round(F.col("v").cast("double"), digits) + 0.0) if digits else got


def ordered_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.with_position(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", total="total")


# Filters and windows over sequences.


@query
def stride_filter(spark, sf_dir):
    return sequence.keep_stride(frames(spark, sf_dir), 3).select("user_id", "event_id", "i", "j")


@query
def skip_filter(spark, sf_dir):
    return sequence.keep_after_skip(frames(spark, sf_dir), 3).select("user_id", "event_id", "i", "j")


@query
def seeded_offset(spark, sf_dir):
    kept = sequence.start_at(turns(spark, sf_dir), sequence.seeded_offset(F.col("conv_id"), 4, 7), "i")
    return kept.select("conv_id", "i", "k")


@query
def chunk_keep_tail(spark, sf_dir):
    return sequence.chunks(frames(spark, sf_dir), ["user_id"], 16, "i")


@query
def window_drop_tail(spark, sf_dir):
    return sequence.windows(sequence.keep_stride(frames(spark, sf_dir), 2), ["user_id"], 4, 2, 30)


@query
def window_conversations(spark, sf_dir):
    return sequence.windows(sequence.keep_stride(turns(spark, sf_dir), 1), ["conv_id"], 2, 1, 30)


@query
def window_true_times(spark, sf_dir):
    return sequence.windows(sequence.keep_stride(frames(spark, sf_dir), 2), ["user_id"], 4, 2, 30, exact_times=True)


@query
def window_offset(spark, sf_dir):
    """Windows from a seeded start; frame numbers and times count from the video's first frame."""
    kept = sequence.keep_stride(frames(spark, sf_dir), 2)
    started = sequence.start_at(kept, sequence.seeded_offset(F.col("user_id"), 4, 7), "j")
    return sequence.windows(started, ["user_id"], 4, 2, 30, index="k", frame="j")


@query
def frame_address(spark, sf_dir):
    numbered = sharding.with_position(table(spark, sf_dir, "events").select("event_id", "user_id"), "user_id", "event_id")
    return sequence.address(numbered, F.col("pos"), 1000).select("event_id", "subdir", "name")


@query
def ordered_collect(spark, sf_dir):
    chunked = frames(spark, sf_dir).withColumn("chunk", F.expr("i div 16"))
    got = sequence.gather(chunked, ["user_id", "chunk"], "i", "event_id", "events")
    return got.select("user_id", "chunk", F.array_join(F.transform("events", lambda x: x.cast("string")), ",").alias("events"))


@query
def window_ordinal(spark, sf_dir):
    return frames(spark, sf_dir).select("event_id", F.expr("i div 16").alias("idx_in_vid"), (F.col("i") % 16).alias("slot"))


# Sharding, orders, draws.


@query
def balanced_split(spark, sf_dir):
    docs = ordered_documents(spark, sf_dir)
    return docs.select("doc_id", sharding.balanced(F.col("pos"), F.col("total"), 7).alias("shard"))


@query
def ceil_shard(spark, sf_dir):
    docs = ordered_documents(spark, sf_dir)
    return docs.select("doc_id", sharding.by_ceiling(F.col("pos"), F.col("total"), 7).alias("shard"))


@query
def two_level_shard(spark, sf_dir):
    return sharding.two_levels(ordered_documents(spark, sf_dir), 3, 4).select("doc_id", "node", "worker")


@query
def round_robin(spark, sf_dir):
    return ordered_documents(spark, sf_dir).select("doc_id", sharding.round_robin(F.col("pos"), 8).alias("worker"))


@query
def seeded_shuffle(spark, sf_dir):
    return shuffle.seeded_shuffle(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 42)


@query
def block_shuffle(spark, sf_dir):
    return shuffle.block_shuffle(ordered_documents(spark, sf_dir), "doc_id", 64, 42).select("doc_id", "pos", "shuffled")


@query
def random_draws(spark, sf_dir):
    return shuffle.draws(ordered_documents(spark, sf_dir), 500, 42).select("draw", "doc_id")


@query
def first_batches(spark, sf_dir):
    """The first 11 batches of 32."""
    docs = ordered_documents(spark, sf_dir).select("doc_id", F.floor(F.col("pos") / 32).cast("long").alias("batch_id"))
    return docs.orderBy("doc_id").limit(11 * 32)


# Joins.


def labelled(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels")


@query
def pair_join(spark, sf_dir):
    docs, labels = labelled(spark, sf_dir)
    return pairing.paired(docs, labels, ["doc_id"])


@query
def sibling_exists(spark, sf_dir):
    docs, labels = labelled(spark, sf_dir)
    return pairing.with_sibling(docs, labels, ["doc_id"])


@query
def anti_skip(spark, sf_dir):
    docs, labels = labelled(spark, sf_dir)
    return pairing.todo(docs, labels, ["doc_id"])


@query
def triple_todo(spark, sf_dir):
    docs, labels = labelled(spark, sf_dir)
    return pairing.triples_todo(docs, labels, labels.where("quality = 1"), ["doc_id"])


@query
def folder_skip(spark, sf_dir):
    """Sources without any labelled document of low quality: the folder-grained anti join."""
    docs, labels = labelled(spark, sf_dir)
    done = docs.join(labels.where("quality = 0"), "doc_id").select("source").distinct()
    return pairing.todo(docs.groupBy("source").agg(F.count("*").alias("n_docs")), done, ["source"])


@query
def fan_in(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    parts = [events.where(F.col("event_id") % 3 == r).withColumn("worker", F.lit(r).cast("long")) for r in range(3)]
    return pairing.fan_in(*parts)


@query
def positional_zip(spark, sf_dir):
    """The n-th document beside the n-th label from the end."""
    docs, labels = labelled(spark, sf_dir)
    return pairing.zipped(docs.select("doc_id"), labels.select(F.col("doc_id").alias("label_id"), (-F.col("doc_id")).alias("_down")), ["doc_id"], ["_down"]).select("pos", "doc_id", "label_id")


@query
def competing_consumers(spark, sf_dir):
    """How often each event was delivered, to whichever of five consumers."""
    taken = sharding.consumers(table(spark, sf_dir, "events").select("event_id"), 5)
    return taken.groupBy("event_id").agg(F.count("*").alias("deliveries"), F.max((F.col("consumer") < 5).cast("long")).alias("known"))


@query
def clamped_workers(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return docs.select("source", sharding.clamped(40, F.col("n")).cast("long").alias("workers"))


@query
def tar_address(spark, sf_dir):
    """Which archive holds which pair: pairs, shuffle, ranks, a shuffle in each rank, addresses."""
    docs, labels = labelled(spark, sf_dir)
    pairs = shuffle.seeded_shuffle(pairing.paired(docs, labels, ["doc_id"]).select("doc_id"), "doc_id", 42, total="total")
    ranked = pairs.withColumn("rank", sharding.balanced(F.col("pos"), F.col("total"), 4))
    size, rest = F.floor(F.col("total") / 4), F.col("total") % 4
    before = F.col("rank") * size + F.least("rank", rest)
    numbered = sharding.with_position(ranked.withColumn("_mix", shuffle.shuffle_key(F.col("doc_id"), 7)), "rank", "_mix", "doc_id", name="p")
    p = F.col("p") - before
    tar = F.floor(p / 10).cast("long")
    return numbered.select(
        "doc_id", "rank", F.floor(tar / 4).cast("long").alias("subdir"), (tar % 4).alias("tar"), (p % 10).alias("member"),
        F.concat(paths.padded(F.col("rank"), 1), F.lit("/"), paths.padded(F.floor(tar / 4).cast("long"), 4), F.lit("/"), paths.padded(tar % 4, 4), F.lit(".tar")).alias("key"))


# Counts and rates.


@query
def running_total(spark, sf_dir):
    return monitor.running_totals(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"]).select("event_id", "running")


@query
def interval_rate(spark, sf_dir):
    daily = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return monitor.interval_rates(daily, "day", "n", 86400.0).select(F.col("day").cast("string").alias("day"), "n", "delta", F.round("per_second", 9).alias("per_second"))


@query
def count_suffix(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.concat(F.col("url"), F.when(F.col("page_id") % 3 == 0, F.lit(".JPG")).when(F.col("page_id") % 3 == 1, F.lit(".depth.jpg")).otherwise(F.lit(""))).alias("path"))
    return monitor.count_images(pages).crossJoin(monitor.count_images(pages, include_depth=False).withColumnRenamed("n_images", "n_rgb"))  # one row each


@query
def throughput(spark, sf_dir):
    span = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))).alias("us"))
    seconds = F.col("us") / 1e6
    return span.select("event_type", "n", F.round(monitor.rate(F.col("n"), seconds), 9).alias("per_second"), F.round(monitor.estimated_total(F.col("n"), 8, seconds), 9).alias("estimated"))


@query
def throughput_at_once(spark, sf_dir):
    """Each user's rate; infinite for a user of one event."""
    span = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count("*").alias("n"), ((F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1e6).alias("s"))
    return span.select("user_id", F.round(monitor.rate(F.col("n"), F.col("s"), float("inf")), 9).alias("per_second"), F.round(monitor.rate(F.col("n"), F.col("s"), 0.0), 9).alias("guarded"))


# Paths.


@query
def suffix_case(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 2 == 0, F.upper("url")).otherwise(F.col("url")).alias("url"))
    return pages.where(paths.has_suffix(F.col("url"), ".html"))


@query
def path_parts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", paths.basename(url).alias("base"), paths.dirname(url).alias("dir"), paths.strip_extension(url).alias("stem"),
        paths.depth_image_path(url).alias("depth_path"), paths.swap_suffix(url, ".html", "_depth.pt").alias("swapped"))


@query
def suffix_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.where(paths.has_suffix(F.col("url"), ".HTML", any_case=True) & ~paths.is_depth_image(F.col("url")))


@query
def digit_folder(spark, sf_dir):
    """Pages whose last folder is a number below 1000: the bounded name domain."""
    name = paths.basename(F.regexp_extract("url", r"^([^?#]*)", 1))
    pages = table(spark, sf_dir, "pages").select("page_id", name.alias("name")).where(F.col("name").rlike("^[0-9]+$"))
    return pages.where(F.col("name").cast("long").between(0, 999)).select("page_id", F.col("name").cast("long").alias("number"))


@query
def padded_name(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", paths.padded(F.col("doc_id"), 6).alias("name"), F.concat(paths.padded(F.col("doc_id"), 8), F.lit("_rgb")).alias("chunk_name"))


# Tensors.


@query
def depth_normalise(spark, sf_dir):
    return pixels(vectors(spark, sf_dir).withColumn("d", tensor.depth_to_bytes(F.col("x"))), "d")


@query
def batch_normalise(spark, sf_dir):
    return pixels(batches.batch_to_bytes(vectors(spark, sf_dir, True), "x", 32), "scaled")


@query
def batch_normalise_padded(spark, sf_dir):
    return pixels(batches.batch_to_bytes(vectors(spark, sf_dir, True), "x", 48, include_padding=True), "scaled")


@query
def collate(spark, sf_dir):
    rows = batches.collate(quantised(vectors(spark, sf_dir, True)), "q", (4, 4, 4), 32)
    return pixels(rows, "tensor", 9, ("vec_id", "batch_id", "row_in_batch"))


@query
def permute(spark, sf_dir):
    return pixels(vectors(spark, sf_dir).withColumn("t", tensor.hwc_to_chw(F.col("x"), 4, 4, 4)), "t")


@query
def flip_channels(spark, sf_dir):
    return pixels(vectors(spark, sf_dir).withColumn("t", tensor.flip_channels(F.slice("x", 1, 48), 4, 4)), "t")


@query
def channel_concat(spark, sf_dir):
    rgb, depth = tensor.to_unit_range(F.slice("q", 1, 48)), tensor.to_unit_range(F.slice("q", 49, 16))
    return pixels(quantised(vectors(spark, sf_dir)).withColumn("t", tensor.concat_channels(rgb, depth)), "t", 9)


@query
def standardise(spark, sf_dir):
    return pixels(quantised(vectors(spark, sf_dir)).withColumn("t", tensor.standardise(tensor.to_unit_range(F.slice("q", 1, 48)), 4, 4)), "t", 9)


@query
def centre_crop(spark, sf_dir):
    h, w = tensor.crop_size(8, 8)
    return pixels(vectors(spark, sf_dir).withColumn("t", tensor.centre_crop(F.col("x"), 8, 8, h, w)), "t")


@query
def resize_half(spark, sf_dir):
    return pixels(vectors(spark, sf_dir).withColumn("t", tensor.resize(F.col("x"), 8, 8, 5, 7)), "t", 6)


@query
def resize_corners(spark, sf_dir):
    return pixels(vectors(spark, sf_dir).withColumn("t", tensor.resize(F.col("x"), 8, 8, 5, 7, align_corners=True)), "t", 6)


@query
def resize_antialias(spark, sf_dir):
    rows, columns = kernels.bilinear_weights(8, 5, "antialias"), kernels.bilinear_weights(8, 3, "antialias")
    return pixels(vectors(spark, sf_dir).withColumn("t", tensor.weighted(F.col("x"), rows, columns)), "t", 6)


@query
def resize_fixed(spark, sf_dir):
    return pixels(quantised(vectors(spark, sf_dir)).withColumn("t", tensor.fixed_point(F.col("q"), 8, 8, 5, 7)), "t")


@query
def channel_axis(spark, sf_dir):
    shape = tensor.unsqueeze(F.array(F.lit(8), F.lit(8)), 0)
    rows = vectors(spark, sf_dir).select("vec_id", F.array_join(shape.cast("array<string>"), "x").alias("shape"), "x")
    return rows.select("vec_id", "shape", F.size("x").cast("long").alias("n"))


@query
def bfloat16_cast(spark, sf_dir):
    return pixels(vectors(spark, sf_dir).withColumn("t", F.transform("x", tensor.to_bfloat16)), "t")


@query
def unit_range_float(spark, sf_dir):
    return pixels(quantised(vectors(spark, sf_dir)).withColumn("t", tensor.to_unit_range(F.col("q"), "float")), "t", 9)


@query
def unit_range_bfloat16(spark, sf_dir):
    return pixels(quantised(vectors(spark, sf_dir)).withColumn("t", tensor.to_unit_range(F.col("q"), "bfloat16")), "t", 9)


@query
def preprocess_rgbd(spark, sf_dir):
    """Bytes of an image and its depth to one tensor for the encoder."""
    return pixels(quantised(vectors(spark, sf_dir)).withColumn("t", batches.preprocess(F.slice("q", 1, 48), F.slice("q", 49, 16))), "t", 9)


@query
def aligned_concat(spark, sf_dir):
    """Two recordings of a video, joined by video and frame number."""
    rows = sequence.with_index(vectors(spark, sf_dir), ["label"], ["vec_id"], "frame_idx")
    left, right = rows.select("vec_id", "label", "frame_idx", F.slice("x", 1, 48).alias("rgb")), rows.select("label", "frame_idx", F.slice("x", 49, 16).alias("depth"))
    return pixels(pairing.aligned(left, right.where("frame_idx % 3 > 0"), ["label"], "frame_idx", ("rgb", "depth"), "t"), "t")


@query
def collate_metadata(spark, sf_dir):
    """Whole batches: their size, their labels in order, the first and last value of the tensors."""
    rows = batches.collate_with_metadata(quantised(vectors(spark, sf_dir, True)), "q", (4, 4, 4), 32, ["vec_id", "label"])
    return rows.select(
        "batch_id", F.size("tensors").cast("long").alias("n"), F.array_join(F.transform("metadata", lambda m: m["vec_id"].cast("string")), ",").alias("ids"),
        F.array_join(F.transform("metadata", lambda m: m["label"].cast("string")), ",").alias("labels"),
        F.round(F.get(F.get("tensors", F.lit(0)), F.lit(0)), 9).alias("first"), F.round(F.get(F.element_at("tensors", -1), F.lit(63)), 9).alias("last"))


@query
def depth_single(spark, sf_dir):
    """One image at a time through the stand-in depth model, then its own depth bytes."""
    depth = models.single(models.mean_depth(), (4, 4, 4), 16)
    rows = vectors(spark, sf_dir).select("vec_id", depth(F.col("x").cast("array<float>")).cast("array<double>").alias("t"))
    return pixels(rows.withColumn("d", tensor.depth_to_bytes(F.col("t"))), "d")


@query
def tensor_stats(spark, sf_dir):
    return batches.summary(vectors(spark, sf_dir), "x", ["label"]).withColumn("mean", F.round("mean", 9))


@query
def padded_batch(spark, sf_dir):
    return batches.batch_sizes(vectors(spark, sf_dir, True), 128)


@query
def encode_batches(spark, sf_dir):
    """The stand-in image encoder through the batched model function, with padded last batches."""
    encode = models.batched(models.block_means(2), (1, 8, 8), 4, 32)
    return pixels(vectors(spark, sf_dir).select("vec_id", encode(F.col("x").cast("array<float>")).alias("t")), "t", 4)


@query
def depth_batches(spark, sf_dir):
    """The stand-in depth model, in padded batches."""
    depth = models.batched(models.mean_depth(), (4, 4, 4), 16, 32)
    rows = vectors(spark, sf_dir).select("vec_id", depth(F.col("x").cast("array<float>")).alias("t"))
    return pixels(rows, "t", 4)


# Streams; each runs to the end of its input and returns what its sink holds.


@query
def stream_windows(spark, sf_dir):
    return stream.run_count_windows(spark, f"{sf_dir}/events.parquet", 16)


@query
def stream_counts(spark, sf_dir):
    return stream.run_counts(spark, f"{sf_dir}/events.parquet")


@query
def stream_encode(spark, sf_dir):
    return stream.run_encoder(spark, f"{sf_dir}/embeddings.parquet")


from . import file_queries as _file_queries  # noqa: E402, F401  (registers its queries)
