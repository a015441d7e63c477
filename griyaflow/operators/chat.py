"""Chat-style training samples, their components, prompts and annotation tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from griyaflow.functions.keys import non_empty
from griyaflow.functions.labels import COMPONENTS, NOT_DETECTED
from griyaflow.functions.text import strip
from griyaflow.operators.houses import has_view, last_of_view, slots

#: Side of the house that shows a component.
SIDE = {"atap": "luar", "dinding": "luar", "lantai": "dalam"}
# Words of a refusal in generated text.
REFUSALS = ("maaf", "sorry", "cannot", "can't", "tidak bisa membantu", "tidak dapat membantu", "i can't", "unable", "refuse", "refusal")
SECTIONS = ("Atap", "Dinding", "Lantai", "Konflik", "Penjelasan")


def schema_letter(images: Column) -> Column:
    """C: both views, A: exterior, B: the rest, pictures or none."""
    ext, inn = has_view(images, "exterior"), has_view(images, "interior")
    return F.when(ext & inn, "C").when(ext, "A").otherwise("B")


def component(name: str, letter: Column, label: Column, status: Column) -> Column:
    """(label, status, needs_text, reason) of a component: not shown by the schema, not seen, or labelled."""
    shown = (letter == "C") | ((letter == "A") & F.lit(SIDE[name] == "luar")) | ((letter == "B") & F.lit(name == "lantai"))
    text = F.trim(F.coalesce(label, F.lit("")))
    unseen = (text == "") | (F.lower(text) == NOT_DETECTED.lower())
    none = lambda why: F.struct(F.lit(NOT_DETECTED).alias("label"), F.lit("Tidak teridentifikasi").alias("status"), F.lit(False).alias("needs_text"), F.lit(why).alias("reason"))
    head = f"Variabel {name} tidak dapat diidentifikasi karena "
    hidden = none(f"{head}foto rumah tampak {SIDE[name]} tidak tersedia.")
    blank = none(f"{head}komponen {name} pada foto rumah tampak {SIDE[name]} tidak terlihat.")
    good = F.struct(text.alias("label"), F.coalesce(non_empty(F.trim(status)), F.lit("Tidak sesuai")).alias("status"), F.lit(True).alias("needs_text"), F.lit("").alias("reason"))
    return F.when(~shown, hidden).when(unseen, blank).otherwise(good)


def table_text(parts: dict[str, Column]) -> Column:
    """Three-row table text; line ends within reasons become spaces, quotes are not escaped."""
    rows = [F.concat(F.lit(f"{n.capitalize()},"), c["label"], F.lit(","), c["status"], F.lit(',"'), F.trim(F.replace(c["reason"], F.lit("\n"), F.lit(" "))), F.lit('"')) for n, c in parts.items()]
    return F.concat_ws("\n", F.lit("Hasil[3]{Komponen,Prediksi,Status,Alasan}:"), *rows)


def prompt_text(house: Column, letter: Column, reference: dict[str, Column]) -> Column:
    """House, view and reference labels, then the task of the schema."""
    view = F.when(letter == "A", "exterior").when(letter == "B", "interior").otherwise("exterior + interior")
    task = F.when(letter == "A", "Nilai atap dan dinding; lantai tidak dinilai.").when(letter == "B", "Nilai lantai; atap dan dinding tidak dinilai.").otherwise("Nilai atap, dinding dan lantai.")
    lines = [F.concat(F.lit("House ID : "), F.coalesce(house, F.lit(""))), F.concat(F.lit("View Type : "), view)]
    lines += [F.concat(F.lit(f"{n.capitalize()} : "), F.coalesce(c, F.lit("-"))) for n, c in reference.items()]
    return F.concat_ws("\n", *lines, task)


def usable(text: Column) -> Column:
    """Generated text is usable when it holds something and no refusal; code fences do not count."""
    bare = strip(F.regexp_replace(F.coalesce(text, F.lit("")), r"```[a-z]*", ""))
    refused = F.lower(bare).rlike("|".join(w.replace("'", ".") for w in REFUSALS))
    return (bare != "") & ~refused


def sections_complete(text: Column, least: int = 80) -> Column:
    """Older gate: all five headings, enough characters, no refusal."""
    out = usable(text) & (F.length(F.coalesce(text, F.lit(""))) >= least)
    for s in SECTIONS:
        out = out & F.coalesce(text.contains(f"{s}:"), F.lit(False))
    return out


def samples(df: DataFrame, system: str, labels: dict[str, Column], status: dict[str, Column]) -> DataFrame:
    """(rec_id, id, messages): system, user with the last picture of each view, assistant with the table text."""
    letter = schema_letter(F.col("images"))
    parts = {c: component(c, F.col("letter"), labels[c], status[c]) for c in COMPONENTS}
    item = lambda kind, text, image: F.struct(F.lit(kind).alias("type"), text.alias("text"), image.alias("image"))
    none = F.lit(None).cast("string")
    picture = lambda v: F.when(last_of_view(F.col("images"), v).isNotNull(), item("image", none, last_of_view(F.col("images"), v)["image_path"]))
    user = F.array_compact(F.array(picture("exterior"), picture("interior"), item("text", prompt_text(F.col("house_id"), F.col("letter"), labels), none)))
    say = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    messages = F.array(say("system", F.array(item("text", F.lit(system), none))), say("user", user), say("assistant", F.array(item("text", table_text(parts), none))))
    return df.withColumn("letter", letter).select("rec_id", F.struct("house_id").alias("id"), messages.alias("messages"))


def annotation_tasks(df: DataFrame, labels: dict[str, Column], kind: Column) -> DataFrame:
    """(rec_id, name, choice): the fixed choices of a task, and KEEP for each picture slot that is filled."""
    cells = dict(slots(F.col("images")))
    choice = lambda name, c: F.struct(F.lit(name).alias("name"), c.alias("choice"))
    out = [choice("house_type_valid", F.coalesce(kind, F.lit("multi")))]
    out += [choice(f"{n}_exists_ctrl", F.when(c != "", "yes").otherwise("no")) for n, c in cells.items()]
    out += [choice(f"jenis_{c}_terluas", F.coalesce(non_empty(F.trim(labels[c])), F.lit("Belum Diisi"))) for c in COMPONENTS]
    out += [F.when(c != "", choice(f"{n}_status", F.lit("KEEP"))) for n, c in cells.items()]
    return df.select("rec_id", F.explode(F.array_compact(F.array(*out))).alias("t")).select("rec_id", "t.*")


def pending(rows: DataFrame, done: DataFrame, cached: DataFrame, key: str) -> DataFrame:
    """Plan of an incremental run: rows not done yet, ``cached`` where a usable text exists, else ``pending``."""
    left = rows.join(done, key, "left_anti").join(cached.select(key).distinct().withColumn("_c", F.lit(True)), key, "left")
    return left.withColumn("plan", F.when(F.col("_c"), "cached").otherwise("pending")).drop("_c")
