"""Queries registered with the driver: operators on the supplied tables, and the domain plans on crew
tables that Spark derives from them."""

from muster.gallery import compliance, domain, operators

_REGISTRIES = [operators.registry, domain.registry, compliance.registry]


def callables():
    return {name: fn for r in _REGISTRIES for name, fn in r.callables().items()}


def sql():
    return {name: q for r in _REGISTRIES for name, q in r.sql().items()}
