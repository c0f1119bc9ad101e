"""Named jobs: the layer builds (bronze, silver, gold, KPIs) and the pipeline."""
