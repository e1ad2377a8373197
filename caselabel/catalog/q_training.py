"""Training, probabilities, saved models and plugged-in classifiers; checked by rows only."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.catalog import roles as ro
from caselabel.catalog.registry import query, rounded
from caselabel.functions import labels as lb
from caselabel.functions import text as tx
from caselabel.operators import datasets as ds
from caselabel.operators import scoring as sc
from caselabel.operators import training as tr
from caselabel.operators.labels import long_enough
from caselabel.session import workspace


def labelled(t):
    """Commission-labelled narratives."""
    label = lb.normalize_label(F.col("delitos_seguimiento_comision"))
    named = t.commission().select("NDD", label.alias("labels")).where(F.col("labels") != vocab.NO_INFORMATION)
    return t.norm().select("NDD", "RELATO").join(named, "NDD")


@query("train_classifier")
def train_classifier(t):
    rows = labelled(t)
    return tr.training_history(rows, tr.train_classifier(rows, "RELATO", "labels"))


@query("train_early_stopping")
def train_early_stopping(t):
    """Training in passes over the training part, measured on the validation part after each."""
    rows = ds.split_hash(labelled(t), "NDD")
    train, valid = (rows.where(F.col("split") == part) for part in ("train", "valid"))
    return tr.pass_history(t.spark, tr.train_until_it_stops_helping(train, valid, "RELATO", "labels", passes=6, features=1 << 10))


@query("predict_probability")
def predict_probability(t):
    rows = labelled(t)
    model = tr.train_classifier(rows, "RELATO", "labels")
    out = tr.predict_probability(t.norm().select("NDD", "RELATO"), model, "RELATO", "label", "probability")
    return rounded(out.select("NDD", "label", "probability"), "probability")


@query("save_load_model")
def save_load_model(t):
    rows = labelled(t)
    path = tr.save_model(tr.train_classifier(rows, "RELATO", "labels"), workspace(t.spark, "model"))
    out = tr.predict_probability(rows, tr.load_model(path), "RELATO", "label", "probability")
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("total"))


def load_marker_model():
    """A classifier of one rule, standing in for a loaded model: the share of articles in a text."""
    articles = {"the", "der", "die", "la", "le", "el"}

    def classify(texts):
        out = []
        for text in texts:
            words = text.split(" ")
            hits = sum(w in articles for w in words)
            label = "ROBO A PERSONAS" if 20 * hits >= len(words) else "OTROS ROBOS"
            out.append((label, 1.0 if label != "OTROS ROBOS" else 0.5))
        return out

    return classify


_ARTICLES = "('the', 'der', 'die', 'la', 'le', 'el')"


@query(
    "plug_in_score",
    f"""WITH {ro.NORM_SQL}, h AS (SELECT NDD, words, len(list_filter(string_split(RELATO, ' '), lambda x: x IN {_ARTICLES})) AS hits FROM norm)
    SELECT NDD, CASE WHEN words >= 50 THEN CASE WHEN 20 * hits >= words THEN 'ROBO A PERSONAS' ELSE 'OTROS ROBOS' END END AS label,
    CASE WHEN words >= 50 THEN CASE WHEN 20 * hits >= words THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END END AS score FROM h""",
)
def plug_in_score(t):
    return sc.plug_in_score(t.norm(), "RELATO", load_marker_model, "label", "score", only=long_enough("words")).select(
        "NDD", "label", "score"
    )


@query("plug_in_score_windows")
def plug_in_score_windows(t):
    out = sc.plug_in_score(
        t.norm(), "RELATO", load_marker_model, "label", "score", only=long_enough("words"), window_words=300
    )
    return rounded(out.select("NDD", "label", "score"), "score")


@query("plug_in_decoded_pages")
def plug_in_decoded_pages(t):
    pages = t.pages.select("page_id", tx.normalize_text(tx.strip_markup(F.col("html"))).alias("relato"))
    return sc.plug_in_score(pages, "relato", load_marker_model, "label", "score").select("page_id", "label", "score")
