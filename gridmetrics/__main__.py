from gridmetrics.jobs import main

main()
