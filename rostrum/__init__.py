"""Spark jobs for dated, speaker-attributed texts and the scores attached to them."""
