"""DataFrame operators over cell frames: versions, filters, shaping, mutations, kNN."""
