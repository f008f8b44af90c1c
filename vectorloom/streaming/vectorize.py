"""Apply a saved profile to a stream of delimited lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vectorloom.operators.profile import Profile
from vectorloom.operators.vectorize import apply_profile, assemble_plain
from vectorloom.sources.delimited import read_delimited


def vectorize_stream(lines: DataFrame, profile: Profile, unseen: str = "minus_one") -> DataFrame:
    """Features and label of every line, as it arrives; stateless."""
    parsed = read_delimited(lines, profile.spec)
    return assemble_plain(apply_profile(parsed, profile, unseen), profile.spec)
