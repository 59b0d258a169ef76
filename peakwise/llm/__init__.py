"""Operators of a training-data pipeline over documents, pages, urls and embeddings.

Every operator takes a frame and returns a frame, keeps rows whole whatever their keys, and
cuts lineage through tables written below ``spark.checkpoint.dir``.  Nothing else in the
package imports this folder.
"""
