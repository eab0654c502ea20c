"""The row-by-row part of the job as a stream."""
