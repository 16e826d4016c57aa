"""Operations of a training-data pipeline; `catalog` registers their queries."""
