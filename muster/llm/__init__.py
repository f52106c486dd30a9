"""Operators for preparing training text: formatting, rules, secrets, quality, sharding, decontamination, near duplicates,
packing, language-model scores and line removal. Nothing else in the library imports this subpackage."""
