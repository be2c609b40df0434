"""Version names that a run reports beside its figures."""

#: Of the code path, of what decides pixels, of the thresholds, and of the tables a run writes; they move independently.
VERSIONS = {"package_version": "0.2.0", "pipeline_version": "lamina.pipeline/2", "recipe_version": "lamina.recipe/1", "gate_version": "lamina.gates/1", "contract_version": "lamina.run/2"}
