"""avionyx: a Spark-native fleet-operations warehouse.

Raw flights, maintenance windows and post-flight reports are cleaned
(``operators.cleaning``), turned into dimensions with stable surrogate keys
(``operators.dimensions``, ``operators.keys``) and aggregated into daily,
monthly and logbook facts (``operators.facts``).  ``plans`` holds the
warehouse build, the KPI reports over it and the same reports computed
straight from the sources, so that the two can be reconciled.

Every operator is a pure ``DataFrame -> DataFrame`` function written with
built-in Spark SQL functions only, so Catalyst plans all of it.
"""

__version__ = "0.1.0"
