"""DataFrame operators for cleaning, labelling and classifying news corpora on Spark."""
