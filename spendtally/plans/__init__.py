"""The four jobs: reconcile, enrich, evaluate, report."""
