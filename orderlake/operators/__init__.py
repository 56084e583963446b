"""DataFrame -> DataFrame transforms. None of them writes, caches or collects."""
