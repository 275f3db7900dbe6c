"""Model compositions: staging cleaners and the star-schema marts."""
