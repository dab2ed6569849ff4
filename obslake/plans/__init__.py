"""Pipeline plans (Bronze to Silver to Gold) and the query catalogue."""
