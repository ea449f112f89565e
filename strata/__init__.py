"""strata: a Spark-native medallion ETL and analytics engine.

Entry points:

* ``strata.plans.medallion.run_medallion`` / ``MedallionParams`` -- the
  bronze / silver / gold (/ serving) flow over any source DataFrame;
* ``strata.plans.api_job.run_api_medallion`` -- crawl a paged JSON API into it;
* ``strata.streaming.incremental.run_incremental_medallion`` -- the same flow
  as an incremental streaming job;
* ``strata.sources.paged_json.read_pages`` -- the paged JSON source;
* ``strata.session.session_conf`` -- session profiles.
"""

__version__ = "0.1.0"
