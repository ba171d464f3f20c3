"""No streaming operator exists in this data model.

Freshness is a batch matter here: change detection, redo of the provisional
tail and dynamic partition overwrite live in ``sources.catalog`` and
``plans.cycle``.
"""
