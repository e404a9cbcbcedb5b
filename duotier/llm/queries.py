"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from . import binary, lattice, license, lm, mixing, packing, periodic, pii, quality, simhash, spans, topk, whiten
from .common import documents

QUERIES = {}


def query(name):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


@query("op1_mixing")
def op1_mixing(spark, d):
    """Every document's block, slot, release, deadline and place in its source, for weights raised to small sources."""
    return mixing.mix(documents(spark, d), keep=["doc_id", "source"])


@query("op2_binary")
def op2_binary(spark, d):
    """Place, length and checksum of every document's ids, read back from the binary files."""
    return binary.round_trip(documents(spark, d))


@query("op3_spans")
def op3_spans(spark, d):
    """Every document without the sentences that an earlier document, or place in it, already has."""
    return spans.deduplicate(documents(spark, d))


@query("op4_license")
def op4_license(spark, d):
    """License notices found in every document."""
    return license.scan(documents(spark, d))


@query("op5_quality")
def op5_quality(spark, d):
    """Rules and verdict of every document."""
    return quality.quality(documents(spark, d), spark.read.parquet(f"{d}/labels.parquet"))


@query("op6_lm")
def op6_lm(spark, d):
    """Base and model log-probability of every document, trained on six sevenths of them."""
    return lm.score(documents(spark, d))


@query("op7_topk")
def op7_topk(spark, d):
    """The 20 best of every 20th vector against all others."""
    return topk.top_k(spark.read.parquet(f"{d}/embeddings.parquet"))


@query("op8_simhash")
def op8_simhash(spark, d):
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(documents(spark, d))


@query("op9_pii")
def op9_pii(spark, d):
    """Personal data of every document."""
    return pii.personal_data(documents(spark, d))


@query("op10_packing")
def op10_packing(spark, d):
    """Place of every piece of every document in sequences of 2048 ids."""
    return packing.pack(documents(spark, d))


@query("op11_lattice")
def op11_lattice(spark, d):
    """Links and component of every vector among those of its label."""
    return lattice.near_duplicates(spark.read.parquet(f"{d}/embeddings.parquet"))


@query("op12_whitening")
def op12_whitening(spark, d):
    """The first 16 whitened coordinates of every vector, and its distance from the mean."""
    return whiten.whiten(spark.read.parquet(f"{d}/embeddings.parquet"))


@query("op13_periodic")
def op13_periodic(spark, d):
    """Periodic runs of words in every document, with planted periods, and what is left without their repeats."""
    return periodic.digests(periodic.find(periodic.with_repeats(documents(spark, d))))
