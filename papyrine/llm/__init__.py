"""Operators for language-model training data. Nothing outside this subpackage imports it."""

from papyrine.llm import abuse, entities, language, leakage, names, neighbours, subjects, tokens

MODULES = [abuse, entities, language, leakage, names, neighbours, subjects, tokens]
