"""Prompts, answers, whole pipelines and their queries."""
