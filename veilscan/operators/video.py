"""Frames and recognised snippets of videos."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import fingerprint, ocr_score

FRAMES, OCR_FRAMES, FRAME_CANDIDATES, SNIPPETS, INTERVAL = 8, 4, 6, 5, 0.5


def frame_times(duration: Column, frames: int = FRAMES, interval: float = INTERVAL) -> Column:
    """Evenly spaced seconds up to a tenth before the end, one for each interval and `frames` at most; multiples of the interval where the duration isn't known."""
    known = F.coalesce(duration, F.lit(0.0)) > 0
    n = F.when(known, F.least(F.lit(frames), F.greatest(F.lit(1), F.floor(duration / interval).cast("int")))).otherwise(frames)
    step = F.when(known, F.greatest(duration - 0.1, F.lit(0.0)) / F.greatest(n - 1, F.lit(1))).otherwise(F.lit(interval))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: i * step)


def times(duration: float | None, frames: int = FRAMES, interval: float = INTERVAL) -> list[float]:
    """The same for one video."""
    known = bool(duration and duration > 0)
    n = min(frames, max(1, int(duration / interval))) if known else frames
    step = max(duration - 0.1, 0.0) / max(n - 1, 1) if known else interval
    return [i * step for i in range(n)]


def frame_score(edge_density: Column, contrast: Column, mid_brightness: Column) -> Column:
    """Worth of a frame for recognition, from shares of edges, spread of grey and middle brightness (0 to 1)."""
    return edge_density * 4.0 + contrast + mid_brightness


def top_frames(frames: DataFrame, video: str = "video", n: int = OCR_FRAMES) -> DataFrame:
    """The n best frames of each video (columns frame, score), ties to the earlier, in order of time."""
    rank = F.row_number().over(Window.partitionBy(video).orderBy(F.col("score").desc(), "frame"))
    return frames.withColumn("rank_", rank).where(F.col("rank_") <= n).drop("rank_")


def scored(candidates: DataFrame) -> DataFrame:
    """candidates (text) with its score."""
    return candidates.withColumn("score", ocr_score(F.col("text")).cast("int"))


def frame_candidates(candidates: DataFrame, video: str = "video", n: int = FRAME_CANDIDATES) -> DataFrame:
    """The n best candidates (frame, score, seq) of each frame, ties to the earlier."""
    rank = F.row_number().over(Window.partitionBy(video, "frame").orderBy(F.col("score").desc(), "seq"))
    return candidates.withColumn("rank_", rank).where(F.col("rank_") <= n).drop("rank_")


#: Bands of an upright and of a wide frame: left, top, right, bottom as hundredths of width and height (fixed values).
UPRIGHT = (("middle_band", 0, 22, 100, 78), ("document_band", 0, 30, 100, 72), ("lower_band", 0, 32, 100, 85))
WIDE = (("center_band", 8, 0, 92, 100), ("middle_strip", 10, 12, 90, 88), ("lower_strip", 8, 30, 92, 100))
LEAST_SIDE = 80


def regions(width: Column, height: Column, document: Column | None = None) -> Column:
    """Named boxes (x0, y0, x1, y1) of a frame that are read: the whole, three bands and the box of a document where one was found.

    Boxes are clamped to the frame; those with a side under LEAST_SIDE and repeated ones are left out.
    """
    part = lambda size, share: F.floor(size * (share / 100)).cast("int")
    box = lambda name, *xs: F.struct(F.lit(name).alias("name"), F.array(*xs).alias("box"))
    banded = lambda kinds: F.array(*(box(n, part(width, a), part(height, b), part(width, c), part(height, d)) for n, a, b, c, d in kinds))
    boxes = F.concat(F.array(box("full", F.lit(0), F.lit(0), width, height)), F.when(height >= width, banded(UPRIGHT)).otherwise(banded(WIDE)))
    if document is not None:
        found = box("detected_document_1", F.greatest(F.lit(0), document[0]), F.greatest(F.lit(0), document[1]), F.least(width, document[2]), F.least(height, document[3]))
        boxes = F.concat(boxes, F.filter(F.array(F.when(document.isNotNull(), found)), lambda b: b.isNotNull()))
    large = F.filter(boxes, lambda b: (b["box"][2] - b["box"][0] >= LEAST_SIDE) & (b["box"][3] - b["box"][1] >= LEAST_SIDE))
    # A fold, as a lambda that names the boxes makes all of them again for each box.
    return F.aggregate(large, F.slice(boxes, 1, 0), lambda kept, b: F.when(F.exists(kept, lambda o: o["box"] == b["box"]), kept).otherwise(F.array_append(kept, b)))


def bands(width: int, height: int, document: tuple[int, int, int, int] | None = None) -> list[tuple[str, tuple[int, int, int, int]]]:
    """The same for one frame."""
    out = [("full", (0, 0, width, height))]
    out += [(n, (int(width * (a / 100)), int(height * (b / 100)), int(width * (c / 100)), int(height * (d / 100)))) for n, a, b, c, d in (UPRIGHT if height >= width else WIDE)]
    if document:
        out.append(("detected_document_1", (max(0, document[0]), max(0, document[1]), min(width, document[2]), min(height, document[3]))))
    first = {box: name for name, box in reversed(out) if box[2] - box[0] >= LEAST_SIDE and box[3] - box[1] >= LEAST_SIDE}
    return [(name, box) for name, box in out if first.get(box) == name]


def text_score(text: str) -> int:
    """quality.ocr_score of one text."""
    t = text.strip()
    if len(t) < 12:
        return 0
    words = sum(sum(map(str.isalpha, w)) >= 3 for w in t.split())
    symbols = sum(not c.isalnum() and not c.isspace() for c in t)
    return words * 12 + sum(map(str.isdigit, t)) * 2 + sum(map(str.isalnum, t)) + t.count("\n") - symbols * 3


def best_snippets(candidates: list[tuple[int, int, str, str, str]], most: int = SNIPPETS) -> list[str]:
    """snippets() of one video: candidates are (score, frame, language, variant, text) in their order."""
    least = max(35, int(max((c[0] for c in candidates), default=0) * 0.45))
    taken: set = set()
    kept = []
    for score, frame, language, variant, text in sorted(candidates, key=lambda c: -c[0]):
        mark = "".join(c.lower() for c in text if c.isalnum())[:120]
        place = (frame, variant.split(" ", 1)[0])
        if score >= least and len(kept) < most and len(mark) >= 20 and not taken & {mark, place}:
            taken |= {mark, place}
            kept.append((frame, f"[frame_{frame:04d}; {language}; {variant}; score={score}]\n{text}"))
    return [text for _, text in sorted(kept, key=lambda k: k[0])]


KEPT = "struct<frame:int,language:string,variant:string,score:int,text:string>"


def snippets(candidates: DataFrame, video: str = "video") -> DataFrame:
    """video, snippets: texts chosen best first, one for each frame and region, no text twice, in order of frames.

    candidates: video, frame, language, variant, score, text, seq.  The choice depends on what is chosen before, so it is
    a fold over each video's candidates (six for each of four frames at most, see frame_candidates), best first.
    """
    row = F.struct((-F.col("score")).alias("order1"), F.col("seq").alias("order2"), F.col("frame").cast("int").alias("frame"), "language", "variant", F.col("score").cast("int").alias("score"), "text", F.concat_ws("/", F.col("frame").cast("string"), F.substring_index("variant", " ", 1)).alias("region"), fingerprint(F.col("text")).alias("mark"))
    grouped = candidates.groupBy(video).agg(F.array_sort(F.collect_list(row)).alias("all_"), F.max("score").alias("best_"))
    least = F.greatest(F.lit(35), F.floor(F.col("best_") * 0.45).cast("int"))
    strings = F.array().cast("array<string>")
    start = F.struct(strings.alias("regions"), strings.alias("marks"), F.array().cast(f"array<{KEPT}>").alias("kept"))

    def step(acc: Column, c: Column) -> Column:
        good = (c["score"] >= F.col("least_")) & (F.size(acc["kept"]) < SNIPPETS) & (c["mark"] != "") & ~F.array_contains(acc["regions"], c["region"]) & ~F.array_contains(acc["marks"], c["mark"])
        one = F.struct(c["frame"].alias("frame"), c["language"].alias("language"), c["variant"].alias("variant"), c["score"].alias("score"), c["text"].alias("text"))
        return F.when(good, F.struct(F.array_append(acc["regions"], c["region"]).alias("regions"), F.array_append(acc["marks"], c["mark"]).alias("marks"), F.array_append(acc["kept"], one).alias("kept"))).otherwise(acc)

    chosen = grouped.withColumn("least_", least).select(video, F.aggregate("all_", start, step, lambda acc: acc["kept"]).alias("kept"))
    by_frame = F.array_sort(F.transform(F.filter(F.arrays_zip(F.col("kept").alias("k"), F.sequence(F.lit(0), F.greatest(F.size("kept"), F.lit(1)) - 1).alias("i")), lambda z: z["k"].isNotNull()), lambda z: F.struct(z["k"]["frame"].alias("frame"), z["i"].alias("i"), z["k"].alias("k"))))
    said = lambda z: F.concat(F.lit("[frame_"), F.lpad(z["k"]["frame"].cast("string"), 4, "0"), F.lit("; "), z["k"]["language"], F.lit("; "), z["k"]["variant"], F.lit("; score="), z["k"]["score"].cast("string"), F.lit("]\n"), z["k"]["text"])
    return chosen.select(video, F.transform(by_frame, said).alias("snippets"))
