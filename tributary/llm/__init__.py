"""Operations of a pipeline that prepares training data. Nothing outside this package imports it."""
