"""DataFrame operators for preparing and analysing image-sensor training corpora."""
