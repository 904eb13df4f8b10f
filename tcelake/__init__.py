"""tcelake — treatment-change-episode analytics as Spark DataFrame jobs.

Sub-packages:
  sources    scans: XML case files, JSON record files, archives, driver-table views
  functions  Column builders (casts, buckets, decades, unit conversion, signatures)
  operators  reusable DataFrame operators (shredders, ranks, pivots, joins, folds)
  plans      the star-schema models, reports and the end-to-end batch job
  sinks      dataset writes and catalog registration
  streaming  incremental ingest of newly arriving case files
"""

from tcelake.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
