"""A non-linear low-rank model of who interacts with what: an autoencoder trained over all people.

The input is a person's scaled strengths, one cell per content; it passes a hidden layer, ``rank`` numbers, a
hidden layer again, and comes out as one value of 0 to 1 per cell. Training lowers the mean squared difference of
output and input over all cells, zeros included, by Adam on the whole gradient: each epoch is one pass over the
people, summed task by task, then by one aggregate.

The model's size is ``width`` cells at any number of contents: contents whose numbers are equal modulo ``width``
share a cell and a score. With ``width`` at least the number of contents none do.

The output of a cell grows with the product of a person's last hidden layer and the cell's weights, so the best
contents are exact top products; no grid of people and contents is made.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubbub.operators.ordering import dense_ids
from hubbub.operators.recommend import best_contents, scaled_strength
from hubbub.operators.sums import summed
from hubbub.session import saved

#: One row per unit: its layer (1 to 4), bias and weights of the layer below.
MODEL = "layer int, unit int, bias double, weights array<double>"
#: Slope of the hidden layers below zero.
LEAK = 0.3
PEOPLE_AT_ONCE = 256
#: Numbers in one row of a gradient.
CHUNK = 64


def person_cells(pairs: DataFrame, people: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """``id, entries``: the cells of each person's scaled strengths, at most ``width``; the largest of a shared cell."""
    cell = F.pmod(F.col("content"), F.lit(width)).cast("int")
    return (
        scaled_strength(pairs)
        .join(people, "person_id")
        .join(items, "content_id")
        .groupBy(F.col("user").alias("id"), cell.alias("cell"))
        .agg(F.max("scaled").cast("double").alias("value"))
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("cell", "value"))).alias("entries"))
    )


def _network(width: int):
    """Functions for the workers, nested so that they need no copy of this package."""
    step, leak = PEOPLE_AT_ONCE, LEAK

    def blocks(entries: pa.ListArray) -> Iterator[np.ndarray]:
        for at in range(0, len(entries), step):
            some = entries.slice(at, step)
            flat = some.flatten()
            row = np.repeat(np.arange(len(some)), np.diff(some.offsets.to_numpy()))
            dense = np.zeros((len(some), width))
            dense[row, flat.field("cell").to_numpy()] = flat.field("value").to_numpy()
            yield dense

    def forward(layers, x):
        """The inputs of all layers, and the output."""
        (w1, b1), (w2, b2), (w3, b3), (w4, b4) = layers
        first = x @ w1.T + b1
        first = np.where(first > 0, first, leak * first)
        code = first @ w2.T + b2
        last = code @ w3.T + b3
        last = np.where(last > 0, last, leak * last)
        return (x, first, code, last), 0.5 * (1 + np.tanh(0.5 * (last @ w4.T + b4)))

    def gradient(layers, x):
        """The sum of squared differences, and its gradient layer by layer."""
        inputs, out = forward(layers, x)
        error = out - x
        back = 2 * error * out * (1 - out)
        found = []
        for i in (3, 2, 1, 0):
            found.append((back.T @ inputs[i], back.sum(axis=0)))
            if i:
                back = back @ layers[i][0]
                if i != 2:  # the code itself is linear
                    back = back * np.where(inputs[i] > 0, 1.0, leak)
        return float((error * error).sum()), found[::-1]

    return blocks, forward, gradient


def _flat(layers) -> np.ndarray:
    return np.concatenate([x.ravel() for layer in layers for x in layer])


def _shaped(flat: np.ndarray, sizes: list[int]):
    layers, at = [], 0
    for below, units in zip(sizes, sizes[1:]):
        weights = flat[at : at + units * below].reshape(units, below)
        layers.append((weights, flat[at + units * below : at + units * (below + 1)]))
        at += units * (below + 1)
    return layers


def fit_autoencoder(
    cells: DataFrame, width: int, rank: int = 5, hidden: int = 100, epochs: int = 50, rate: float = 0.03, seed: int = 1
) -> tuple[DataFrame, list[float]]:
    """The model, and the mean squared difference before each epoch.

    ``cells`` (of ``person_cells``) is read ``epochs`` times: pass saved rows. The driver holds the model, which has
    some ``2 * width * hidden`` numbers. Without people the model is its random start.
    """
    spark = cells.sparkSession
    sizes = [width, hidden, rank, hidden, width]
    random = np.random.default_rng(seed)
    start = [(random.standard_normal((n, m)) * np.sqrt(2 / m), np.zeros(n)) for m, n in zip(sizes, sizes[1:])]
    weights = _flat(start)
    slope, spread = np.zeros_like(weights), np.zeros_like(weights)
    height = -(-(len(weights) + 2) // CHUNK)
    blocks, _, gradient = _network(width)
    entries, losses = cells.select("entries"), []
    for epoch in range(1, epochs + 1):
        shared = spark.sparkContext.broadcast(_shaped(weights, sizes))

        def part(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros(height * CHUNK)
            for batch in batches:
                for x in blocks(batch.column(0)):
                    loss, found = gradient(shared.value, x)
                    own = np.concatenate([[loss, x.size], *[g.ravel() for layer in found for g in layer]])
                    total[: len(own)] += own
            return total.reshape(height, -1)

        total = summed(entries, part, height, CHUNK).ravel()
        shared.destroy()
        if not total[1]:
            break
        losses.append(float(total[0] / total[1]))
        steepest = total[2 : 2 + len(weights)] / total[1]
        slope = 0.9 * slope + 0.1 * steepest
        spread = 0.999 * spread + 0.001 * steepest**2
        weights = weights - rate * (slope / (1 - 0.9**epoch)) / (np.sqrt(spread / (1 - 0.999**epoch)) + 1e-8)
    rows = [
        (i, unit, float(bias[unit]), matrix[unit].tolist())
        for i, (matrix, bias) in enumerate(_shaped(weights, sizes), 1)
        for unit in range(len(bias))
    ]
    return spark.createDataFrame(rows, MODEL), losses


def model_layers(model: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights and biases of the four layers; the model comes to the driver."""
    rows = sorted(model.select("layer", "unit", "bias", "weights").collect())
    own = [[r for r in rows if r["layer"] == i] for i in range(1, 5)]
    return [(np.array([r["weights"] for r in layer]), np.array([r["bias"] for r in layer])) for layer in own]


def person_vectors(cells: DataFrame, model: DataFrame) -> DataFrame:
    """``id, features``: a person's last hidden layer, and 1."""
    layers = model_layers(model)
    shared = cells.sparkSession.sparkContext.broadcast(layers)
    blocks, forward, _ = _network(layers[0][0].shape[1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in blocks(batch.column(1)):
                last = forward(shared.value, x)[0][3]
                features = list(np.hstack([last, np.ones((len(x), 1))]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(x)), pa.array(features, pa.list_(pa.float64()))], names=["id", "features"]
                )
                at += len(x)

    return cells.select(F.col("id").cast("long").alias("id"), "entries").mapInArrow(run, "id long, features array<double>")


def content_vectors(items: DataFrame, model: DataFrame, width: int) -> DataFrame:
    """``id, features``: the weights and the bias of each content's cell."""
    cells = model.where(F.col("layer") == 4).select("unit", F.concat("weights", F.array("bias")).alias("features"))
    numbered = items.select(F.col("content").cast("long").alias("id"), F.pmod(F.col("content"), F.lit(width)).cast("int").alias("unit"))
    return numbered.join(cells, "unit").select("id", "features")


def autoencoder_factors(pairs: DataFrame, width: int, **setting) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(person vectors, content vectors, person_dict, content_dict)`` as ``recommend.fit_factors`` returns them.

    ``pairs`` is read several times: pass saved rows.
    """
    people = saved(dense_ids(pairs, "person_id", "user"))
    items = saved(dense_ids(pairs, "content_id", "content"))
    cells = saved(person_cells(pairs, people, items, width))
    model = fit_autoencoder(cells, width, **setting)[0]
    return person_vectors(cells, model), content_vectors(items, model, width), people, items


def autoencoder_recommendations(
    pairs: DataFrame, width: int, k: int = 10, people_wanted: DataFrame | None = None, **setting
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Best ``k`` contents per person by the model's output; see ``recommend.member_recommendations``."""
    persons, contents, people, items = autoencoder_factors(pairs, width, **setting)
    if people_wanted is not None:
        wanted = people.join(people_wanted.select("person_id"), "person_id", "left_semi")
        persons = persons.join(wanted.select(F.col("user").cast("long").alias("id")), "id", "left_semi")
    found = best_contents(persons, contents, k)
    return found.withColumn("score", 1 / (1 + F.exp(-F.col("score")))), people, items
