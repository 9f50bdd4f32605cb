from candlemill.plans.jobs import run
from candlemill.session import build_session

if __name__ == "__main__":
    run(build_session())
