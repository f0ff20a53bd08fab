"""Operators of a training-data pipeline: cleaning, dedup, decontamination, scoring, mixing, sharding, chat."""
