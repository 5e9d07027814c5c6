"""Column-expression functions: byte codecs, geohash, key builders."""
