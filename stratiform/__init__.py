"""stratiform: weighted survey analytics as Spark DataFrame operators.

Entry points:

* ``stratiform.functions`` -- Column builders (decode, weighted estimators)
* ``stratiform.operators`` -- dense row ids, exact percentiles, weights, checks
* ``stratiform.sources``   -- XPT data source, landing manifest, ingest, seeds
* ``stratiform.plans``     -- survey models, marts, check suites, ``run_pipeline``
* ``stratiform.streaming`` -- incremental landing of new yearly files
"""

__version__ = "0.1.0"
